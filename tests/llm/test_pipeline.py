"""The pipeline beside its rules, stage by stage, on a small corpus with known cases."""

import random

import pytest

import corpus_pipeline
from tests.llm.conftest import BENCHMARK, awkward_rows
from tests.llm.test_simhash import plain_components, plain_fingerprint


def corpus():
    rng = random.Random(4)
    words = {"en": [f"the{i}ing" for i in range(200)], "de": [f"über{i}ung" for i in range(200)]}
    rows = []
    for i in range(120):
        lang = "en" if i % 3 else "de"
        rows.append((i, " ".join(rng.choice(words[lang]) for _ in range(80)), lang, f"s{i % 4}"))
    rows += [(200 + i, rows[i % 3][1], "en", "s9") for i in range(40)]  # a third are copies
    rows += [(300 + i, f"{rows[i][1][:60]} {BENCHMARK}", "en", "s1") for i in range(3)]
    return rows + [(400, "12 34 !", "en", "s1"), (401, None, "en", "s1"), (402, "", None, None)]


def test_stages_on_known_cases(spark, write_tables):
    path = write_tables(corpus())
    docs = spark.read.parquet(f"{path}/documents.parquet")
    text = {i: t for i, t, _, _ in corpus()}
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language"](spark, docs, path)
    assert ids(kept) == sorted(i for i in text if i < 400)
    single = stages["near_dedup"](spark, kept, path)
    left = sorted(i for i in text if i < 400)
    groups = plain_components(left, [plain_fingerprint(text[i]) for i in left])
    assert ids(single) == sorted(set(groups)) and not set(ids(single)) & set(range(200, 240))
    clean = stages["decontaminate"](spark, single, path)
    assert ids(clean) == [i for i in ids(single) if not 300 <= i < 303]
    mixed = stages["mix"](spark, clean, path)
    assert set(ids(mixed)) <= set(ids(clean))
    assert mixed.count() == pytest.approx(1.5 * clean.count(), rel=0.1)
    placed = stages["shard"](spark, mixed, path).toPandas()
    assert sorted(placed["doc_id"]) == ids(mixed)
    n = placed.groupby("shard").size()
    assert n.max() - n.min() <= 1 and len(n) == 40


def test_run_is_the_chain_of_its_stages(spark, write_tables):
    path = write_tables(corpus())
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    key = lambda df: sorted((r["doc_id"], r["text"], r["shard"]) for r in df.collect())
    assert [k[:2] for k in key(corpus_pipeline.run(spark, path))] == [k[:2] for k in key(docs)]


def test_awkward_and_empty_tables(spark, awkward, empty):
    out = corpus_pipeline.run(spark, awkward)
    assert {r["doc_id"] for r in out.collect()} <= {r[0] for r in awkward_rows()}
    assert corpus_pipeline.run(spark, empty).count() == 0
