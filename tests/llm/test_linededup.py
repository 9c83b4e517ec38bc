import hashlib
import random
from collections import defaultdict

import pytest

from tillwise.llm import linededup


def plain(rows, least):
    """For every line the longest run that stands earlier too, found by looking."""
    sequence = [
        (i, n, line, len(line.encode().split()))
        for i, text in sorted(rows) for n, line in enumerate((text or "").split("\n")) if line.encode().split()
    ]
    earlier, gone = defaultdict(list), set()
    for p, (i, _, line, _) in enumerate(sequence):
        for q in earlier[line]:
            k = words = 0
            while p + k < len(sequence) and sequence[p + k][0] == i and sequence[q + k][0] == sequence[q][0]:
                if sequence[p + k][2] != sequence[q + k][2]:
                    break
                words += sequence[p + k][3]
                k += 1
            if words >= least:
                gone |= {(i, sequence[p + z][1]) for z in range(k)}
        earlier[line].append(p)
    return gone


@pytest.mark.parametrize("seed", range(3))
def test_same_as_looking(spark, write_tables, seed):
    rng = random.Random(seed)
    lines = ["a", "b c", "d e f", "", "g h i j k l", " ", "m " * 12, "n", "only " + "o " * rng.randrange(3)]
    rows = []
    for i in range(60):
        text = [rng.choice(lines) for _ in range(rng.randrange(14))]
        if rows and rng.random() < 0.5:
            other = rng.choice(rows)[1].split("\n")
            at = rng.randrange(len(other) + 1)
            text[2:2] = other[at : at + rng.randrange(9)]
        if rng.random() < 0.3:
            text.append(f"unique {i}")
        rows.append((i, "\n".join(text)))
    # the periodic and the wholly equal
    rows += [(70, "\n".join(["a"] * 40)), (71, "\n".join(["a", "b c"] * 20)), (72, rows[0][1]), (73, rows[0][1])]
    for least in (1, 7, 20):
        gone = plain(rows, least)
        docs = spark.read.parquet(f"{write_tables([(i, t, 'en', 'web') for i, t in rows])}/documents.parquet")
        got = {r["doc_id"]: r for r in linededup.deduplicated(docs, least).collect()}
        for i, text in rows:
            kept = [line for n, line in enumerate(text.split("\n")) if (i, n) not in gone]
            assert got[i]["n_deleted"] == sum(d == i for d, _ in gone), (least, i)
            assert got[i]["text"] == "\n".join(kept)


def test_ranks_are_places_in_the_suffix_array(spark):
    rng = random.Random(9)
    rows = [(1, 0, n, n, rng.randrange(3), 0, 1, -1) for n in range(40)]
    lines = spark.createDataFrame(rows, "doc_id long, hash long, seq int, line int, h1 long, h2 long, n_words int, island int")
    got = {r["seq"]: r["ranks"] for r in linededup.ranked(lines, 16).collect()}
    ids = [r[4] for r in rows]
    for level in range(5):
        reach = 1 << level
        whole = [p for p in range(40) if p + reach <= 40]
        for p in whole:
            for q in whole:
                a, b = ids[p : p + reach], ids[q : q + reach]
                assert (got[p][level] < got[q][level]) == (a < b) and (got[p][level] == got[q][level]) == (a == b)
        assert all(got[p][level] is None for p in range(40) if p + reach > 40)


def test_first_copy_stays_and_short_repeats_too(spark, write_tables):
    passage = " ".join(f"word{i}" for i in range(51))
    rows = [(3, f"intro\n{passage}\nend", "en", "w"), (1, f"{passage}\nshort line", "en", "w"), (2, "short line", "en", "w")]
    got = {r["doc_id"]: r for r in linededup.op5_suffix_line_dedup(spark, write_tables(rows)).collect()}
    assert [got[i]["n_deleted"] for i in (1, 2, 3)] == [0, 0, 1]
    assert got[3]["kept_sha256"] == hashlib.sha256(b"intro\nend").hexdigest() and got[3]["deleted_words"] == 51
