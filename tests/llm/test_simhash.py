import itertools

import numpy as np
import xxhash

from tests.llm.conftest import awkward_rows
from tillwise.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    root = list(range(len(ids)))
    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2 and root[i] != root[j]:
            old, new = root[j], root[i]
            root = [new if r == old else r for r in root]
    least = {}
    for i, r in zip(ids, root, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [least.get(r) for r in root]


def test_same_as_brute_force(spark, awkward):
    rows = awkward_rows()
    prints = [plain_fingerprint(t) for _, t, _, _ in rows]
    parts = plain_components([r[0] for r in rows], prints)
    want = sorted(str((r[0], f"{p:016x}", c)) for r, p, c in zip(rows, prints, parts, strict=True))
    got = simhash.op7_simhash_trie(spark, awkward).collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_hash_is_sparks(spark):
    got = spark.sql("SELECT xxhash64('straße ñ 3')").head()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("straße ñ 3".encode(), 42)


def test_long_texts_in_pieces(monkeypatch):
    text = "ab cd ef gh " * 5000
    whole = simhash.fingerprints([text])
    from tillwise.llm import text as words

    monkeypatch.setattr(simhash, "token_pieces", lambda data: (p.split() for p in words.pieces(data, 100)))
    assert (simhash.fingerprints([text], batch=50) == whole).all()


def test_trie_join_finds_all_pairs_of_a_cluster(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 20, np.uint64)
    values = {int(c) for c in centres}
    for c in centres:  # chains and balls of up to 4 flipped bits
        for _ in range(30):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            values.add(int(c) ^ sum(1 << int(b) for b in flips))
    values |= {0, 1, 3, 7, (1 << 64) - 1, (1 << 64) - 2, 1 << 63}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    leaves = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {(r["a"], r["b"]) for r in simhash.near_pairs(leaves).collect()}
    want = {
        (min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2
    }
    assert got == want


def test_components_of_a_long_chain(spark):
    order = np.random.default_rng(6).permutation(300).tolist()
    pairs = [(min(a, b), max(a, b)) for a, b in zip(order, order[1:], strict=False)] + [(1000, 1001)]
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(300), 0), 1000: 1000, 1001: 1000}


def test_stage_keeps_one_of_each_component(spark, awkward):
    rows = awkward_rows()
    parts = plain_components([r[0] for r in rows], [plain_fingerprint(r[1]) for r in rows])
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    kept = sorted(str(r["doc_id"]) for r in simhash.stage(spark, docs, awkward).collect())
    assert kept == sorted({str(c) for c in parts})
