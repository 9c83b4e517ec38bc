import math
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ENGLISH, GERMAN
from tillwise.llm import langid


class PlainTree:
    """One language's tree, byte by byte: dictionaries, and the recursion as defined."""

    def __init__(self, texts, order, classes):
        self.order, self.classes, self.width = order, classes, max(classes.values(), default=-1) + 2
        self.seen = {}
        for text in texts:
            data = b"\0" * order + text.encode()
            for i in range(order, len(data)):
                self.seen.setdefault(data[i - order : i], {}).setdefault(data[i], 0)
                self.seen[data[i - order : i]][data[i]] += 1

    def counts(self, context):
        out = {}
        for full, after in self.seen.items():
            if full.endswith(context):
                for byte, n in after.items():
                    out[byte] = out.get(byte, 0) + n
        return out

    def bits(self, context, byte):
        counts = self.counts(context)
        total, kinds = sum(counts.values()), len(counts)
        if byte in counts:
            return math.log2((total + kinds) / counts[byte])
        escape = math.log2((total + kinds) / kinds) if total else 0.0
        return escape + (self.bits(context[1:], byte) if context else math.log2(self.width))

    def length(self, text):
        data = b"\0" * self.order + text.encode()
        return sum(self.bits(data[i - self.order : i], data[i]) for i in range(self.order, len(data)))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_code_lengths_are_those_of_the_definition(spark, order):
    training = {"de": [GERMAN, "über"], "en": [ENGLISH, ENGLISH[5:60]]}
    docs = spark.createDataFrame([(t, la) for la, ts in training.items() for t in ts] + [(None, "en"), ("x", None)], "text string, lang string")
    counts = langid.count_contexts(docs, order).toPandas()
    models = langid.Models(counts, order)
    assert models.langs == ["de", "en"]
    seen = {b for ts in training.values() for t in ts for b in b"\0" + t.encode()}
    classes = {b: i for i, b in enumerate(sorted(seen))}
    for text in (ENGLISH[:90], "Zürich ÄÖ", "the", "q", "ñ" * 3):
        got = models.total_bits([text])[0]
        want = [PlainTree(training[la], order, classes).length(text) for la in models.langs]
        assert got == pytest.approx(want, rel=1e-5)


def test_lengths_are_those_of_a_probability(spark):
    docs = spark.createDataFrame([(ENGLISH, "en")], "text string, lang string")
    models = langid.Models(langid.count_contexts(docs).toPandas())
    data = np.array([b"\0\0", *[ENGLISH.encode()[i : i + 2] for i in range(60)], b"qq", b"\xc3\xbc"])
    contexts = np.array([c[0] << 8 | c[1] if len(c) == 2 else 0 for c in data.tolist()])
    seen = np.unique(np.frombuffer(b"\0" + ENGLISH.encode(), np.uint8)).astype(int)
    codes = (contexts[:, None] << 8) | np.append(seen, 255)
    table = 2.0 ** -models.bits(codes.ravel())[:, 0].reshape(codes.shape)
    # escapes leave room unused, so sums stay at 1 or below
    assert table.sum(1).max() <= 1 + 1e-5


def test_memory_follows_the_contexts_seen():
    # a dense table of these would take 40 x 201^3 numbers
    rng = np.random.default_rng(1)
    langs, each = [f"l{i:02d}" for i in range(40)], 50_000
    frames = []
    for lang in langs:
        code = np.unique(rng.integers(0, 200, (each, 3)) @ np.array([1 << 16, 1 << 8, 1]))
        frames.append(pd.DataFrame({"lang": lang, "code": code, "n": rng.integers(1, 9, len(code))}))
    counts = pd.concat(frames, ignore_index=True)
    tracemalloc.start()
    models = langid.Models(counts)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert models.width == 201 and held < 80 << 20 and peak < 200 << 20
    assert models.total_bits(["abc", ""]).shape == (2, 40)


def test_pieces_of_a_long_text(monkeypatch):
    counts = pd.DataFrame({"lang": "en", "code": [1, 2, 3 << 8 | 1], "n": [3, 1, 2]})
    models = langid.Models(counts)
    whole = models.total_bits([ENGLISH * 3, None, "x"])
    monkeypatch.setattr(langid, "_CHUNK", 7)
    assert models.total_bits([ENGLISH * 3, None, "x"]) == pytest.approx(whole)


def test_held_out_accuracy(spark, write_tables):
    rows = []
    for i in range(150):
        words = (ENGLISH if i % 2 else GERMAN).split()
        rows.append((i, " ".join(words[(i * 7 + j * j) % len(words)] for j in range(25)), "en" if i % 2 else "de", "web"))
    got = langid.op8_ppm_language(spark, write_tables(rows)).where("held_out").toPandas()
    assert set(got["doc_id"]) == {i for i in range(150) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert (got["lang_pred"] == got["doc_id"].map(lambda i: "en" if i % 2 else "de")).mean() > 0.95
    assert got["score"].between(0, 1).all()


def test_und_and_the_stage(spark, awkward):
    out = langid.op8_ppm_language(spark, awkward)
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    lettered = docs.where(F.col("text").rlike(r"\p{L}"))
    assert out.where("lang_pred = 'und'").count() == docs.count() - lettered.count()
    assert out.where("lang_pred = 'und' and score != 0").count() == 0
    # certain documents stay, with all their columns
    kept = langid.stage(spark, docs, awkward)
    sure = out.where(f"lang_pred != 'und' and score >= {langid.REJECT_BELOW}")
    assert kept.count() == sure.count() and kept.where("doc_id in (1, 4, 100)").count() == 3
