import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import pyarrow as pa
from tests.llm.conftest import awkward_rows
from tillwise.llm import fim

UNIT = re.compile(r"[\x20\t-\r]*[^\x20\t-\r]+|[\x20\t-\r]+")


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    if h4 % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_same_as_plain_python(spark, awkward):
    rows = fim.fill_in_middle(spark.read.parquet(f"{awkward}/documents.parquet")).collect()
    got = sorted((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows)
    want = sorted((str(i), *plain(i, t)) for i, t, _, _ in awkward_rows())
    assert list(map(str, got)) == list(map(str, want)) and {r.form for r in rows} == {"plain", "psm", "spm"}


def test_every_output_gives_its_text_back(spark, write_tables):
    texts = ["a b  c\n", " ", "<P>", "x <S> y", "< P> z", "<S", "a<", ">b <", "ß ü x", "\0 \x0b\x1c y", "w " * 70_000]
    rows = [(i, texts[i % len(texts)], "en", "web") for i in range(300)]
    made = fim.fill_in_middle(spark.read.parquet(f"{write_tables(rows)}/documents.parquet"))
    back = made.select("doc_id", "form", "output", fim.restore(F.col("output"), F.col("form")).alias("text")).collect()
    assert {r.doc_id: r.text for r in back} == {i: t for i, t, _, _ in rows}
    assert all((r.form == "plain") == (r.output == r.text) for r in back)
    assert all(r.form == "plain" for r in back if re.search("<[PSM]>", r.text))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab\n\x20\t\x0b é\U0001f600<>PSM", max_size=30), *[st.integers(0, 2**32 - 1)] * 2), min_size=1))
def test_parts_of_any_text(rows):
    texts, h1, h2 = map(list, zip(*rows, strict=True))
    flags = pa.array([True] * len(rows))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(rows))), pa.array(texts), pa.array(h1), pa.array(h2), flags, pa.array([False] * len(rows))],
        names=["doc_id", "text", "h1", "h2", "changed", "suffix_first"],
    )
    for text, x, y, r in zip(texts, h1, h2, fim.cut_batch(batch).to_pylist(), strict=True):
        units = UNIT.findall(text)
        a, b = sorted((x % (len(units) + 1), y % (len(units) + 1)))
        assert r["n"] == len(units)
        if r["form"] == "psm":
            assert r["output"] == f"<P>{''.join(units[:a])}<S>{''.join(units[b:])}<M>{''.join(units[a:b])}"
        else:
            assert r["output"] == text and (not text or re.search("<[PSM]>", text))


@pytest.mark.parametrize("changed, suffix_first, forms", [(0, 50, {"plain"}), (100, 0, {"psm"}), (100, 100, {"spm"})])
def test_rates(spark, write_tables, changed, suffix_first, forms):
    docs = spark.read.parquet(f"{write_tables([(i, 'a b c', 'en', 'web') for i in range(40)])}/documents.parquet")
    got = fim.fill_in_middle(docs, changed=changed, suffix_first=suffix_first).collect()
    assert {r.form for r in got} == forms and len({r.output for r in got}) > len(forms) - 1
