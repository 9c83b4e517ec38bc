import hashlib

import numpy as np
import pytest

from tests.llm.conftest import ENGLISH, awkward_rows
from tillwise.llm import minhash, registry


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_texts_and_likeness(spark, awkward):
    rows = [(i, t or "") for i, t, _, _ in awkward_rows() if i is not None and i != 5]
    rows = sorted(rows, reverse=True)
    got = {r["doc_id"]: r for r in minhash.op10_minhash_prints(spark, awkward).collect()}
    for (i, text), (after, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        if {i, after} & {6, 4} or i == 1:  # beside the repeated id, and before the null ids
            continue
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(got[i]["near_edited"] - jaccard(text, changed)) < 0.2
        assert abs(got[i]["near_next"] - jaccard(text, following)) < 0.2


def test_order_wraps_around_whatever_the_parts(spark, write_tables):
    rows = [(i * 37 % 101, f"text number {i} " * (1 + i % 5), "en", "web") for i in range(101)]
    by_id = {i: t for i, t, _, _ in rows}
    for parts in ("1", "4", "64"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = minhash.op10_minhash_prints(spark, write_tables(rows)).collect()
        spark.conf.set("spark.sql.shuffle.partitions", before)
        assert len(got) == 101
        for r in got:
            text, following = by_id[r["doc_id"]], by_id[(r["doc_id"] - 1) % 101]
            n = len(text) // 3
            assert r["edited_sha256"] == hashlib.sha256((text[: len(text) - n] + following[:n]).encode()).hexdigest()


def test_a_document_alone_follows_itself(spark, write_tables):
    (row,) = minhash.op10_minhash_prints(spark, write_tables([(3, "abcdef", "en", "web")])).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0


def test_signature_is_the_plain_minimum():
    signer = minhash.Signer(8)
    text = ENGLISH + " " + ENGLISH[::-1]
    hashes = [int(h) >> 32 for part in minhash.shingle_sets(text, minhash.Hashes()) for h in part]
    want = [min((x * int(a) + int(b)) % (1 << 64) for x in hashes) >> 32 for a, b in zip(signer.a, signer.b, strict=True)]
    assert signer.sign(["x", text, None])[1].tolist() == want
    assert (signer.sign([None])[0] == 0xFFFFFFFF).all()


def test_long_texts_in_pieces(monkeypatch):
    text = ENGLISH * 40
    whole = minhash.Signer().sign([text])
    from tillwise.llm import text as words

    monkeypatch.setattr(minhash, "token_pieces", lambda data: (p.split() for p in words.pieces(data, 64)))
    monkeypatch.setattr(minhash, "_CHUNK", 50)
    assert (minhash.Signer().sign([text, "a b"])[:1] == whole).all()


def test_permutations_estimate_jaccard():
    words = ENGLISH.split()
    signer = minhash.Signer()
    for cut in (0, 10, 25, 40):
        other = " ".join(words[: len(words) - cut] + ["new"] * cut)
        a, b = signer.sign([ENGLISH, other])
        assert abs(minhash.likeness(a, b) - jaccard(ENGLISH, other)) < 0.15


def test_near_duplicates_are_the_classes_of_similar_texts(spark, write_tables):
    rng = np.random.default_rng(8)
    words, rows = [f"w{i}" for i in range(500)], []
    for group in range(12):
        base = [words[j] for j in rng.integers(0, 500, 120)]
        for copy in range(6):
            text = list(base)
            for j in rng.integers(0, 120, copy % 3):
                text[j] = f"x{group}{copy}"
            rows.append((group * 10 + copy, " ".join(text), "en", "web"))
    rows += [(900, None, "en", "web"), (901, "", "en", "web"), (902, "", "en", "web"), (None, rows[0][1], "en", "web")]
    docs = spark.read.parquet(f"{write_tables(rows)}/documents.parquet")
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    texts = [t for _, t, _, _ in rows[:72]]
    parent = list(range(72))
    for i in range(72):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8:
                old, new = parent[i], parent[j]
                parent = [new if p == old else p for p in parent]
    want = {rows[i][0]: rows[min(k for k in range(72) if parent[k] == parent[i])][0] for i in range(72)}
    want |= {900: 900, 901: 900, 902: 900, None: 0}
    assert {r["doc_id"]: r["class_id"] for r in got} == want


@pytest.mark.parametrize("block", [256, 5])
def test_every_link_of_a_chain_and_a_hot_group(spark, write_tables, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = [f"w{j}" for j in rng.integers(0, 500, 150)]
    texts = []
    for i in range(25):  # one edit from the one before: neighbours are alike, the ends are not
        base = list(base)
        base[(i * 37) % 150] = f"c{i}"
        texts.append(" ".join(base))
    for i in range(30):  # near copies, some just within and some just beyond the limit
        copy = list(base)
        for j in rng.integers(0, 150, 1 + i % 4):
            copy[j] = f"h{i}"
        texts.append(" ".join(copy))
    texts += [texts[0].upper(), texts[3] + "  ", texts[3], "alone with these few words here", ""]
    path = write_tables([(i, t, "en", "web") for i, t in enumerate(texts)])
    got = {r["doc_id"]: r for r in registry.QUERIES["op10_near_duplicates"](spark, path).collect()}
    distinct = sorted(set(texts))
    alike = {t: [u for u in distinct if u != t and shingles(t) and jaccard(t, u) >= 0.8] for t in distinct}
    assert {i: got[i]["n_links"] for i in got} == {i: len(alike[t]) for i, t in enumerate(texts)}
    for i, text in enumerate(texts):
        reached, fresh = {text}, [text]
        while fresh:
            fresh = [u for t in fresh for u in alike[t] if u not in reached and not reached.add(u)]
        assert got[i]["class_id"] == min(k for k, t in enumerate(texts) if t in reached)


def test_near_duplicates_of_awkward_and_empty_tables(spark, awkward, empty):
    got = minhash.op10_near_duplicates(spark, awkward)
    assert got.dtypes == [("doc_id", "bigint"), ("class_id", "bigint"), ("n_links", "bigint")]
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(str(r[0]) for r in awkward_rows())
    assert minhash.op10_near_duplicates(spark, empty).count() == 0
