"""Every query over the awkward and over the empty tables: whole results of the stated shape."""

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import awkward_rows
from tillwise.llm import registry

SHAPES = {
    "op1_crf_pii": "doc_id bigint,n_email bigint,n_ip bigint,n_card bigint,n_phone bigint,base_sha256 string,spans string",
    "op2_ring_shards": "doc_id bigint,size bigint,text_crc32 bigint,law string,shard int,slot bigint,grown_shard int",
    "op3_prefix_decontaminate": "doc_id bigint,n_words bigint,n_hit bigint,n_items bigint,items_sha256 string,contaminated boolean",
    "op4_backoff_scores": "doc_id bigint,held_out boolean,n_tokens bigint,n_known bigint,train_tokens bigint,base_score double,score double",
    "op5_suffix_line_dedup": "doc_id bigint,n_lines bigint,n_deleted bigint,deleted_words bigint,kept_sha256 string",
    "op6_tree_mix": "doc_id bigint,size bigint,source_size bigint,target double,taken bigint,shards string",
    "op7_simhash_trie": "doc_id bigint,fingerprint string,component_id bigint",
    "op8_ppm_language": "doc_id bigint,held_out boolean,lang_pred string,score double",
    "op9_fm_toxicity": "doc_id bigint,held_out boolean,score double,predicted int",
    "op10_minhash_prints": "doc_id bigint,n_chars bigint,edited_sha256 string,fingerprint string,edited_fingerprint string,"
    "near_edited double,near_next double",
    "op12_fill_in_middle": "doc_id bigint,n bigint,form string,prefix_chars bigint,middle_chars bigint,output_sha256 string,"
    "restored_sha256 string",
}


@pytest.mark.parametrize("name", SHAPES)
def test_every_row_has_its_result(spark, awkward, name):
    out = registry.QUERIES[name](spark, awkward)
    assert ",".join(f"{n} {t}" for n, t in out.dtypes) == SHAPES[name]
    found = [r.asDict() for r in out.collect()]
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in awkward_rows())
    may_be_unset = {"doc_id", "grown_shard", "component_id", "prefix_chars", "middle_chars"}
    assert not [r for r in found if any(v is None for c, v in r.items() if c not in may_be_unset)]


@pytest.mark.parametrize("name", SHAPES)
def test_empty_tables(spark, empty, name):
    out = registry.QUERIES[name](spark, empty)
    assert out.count() == 0 and ",".join(f"{n} {t}" for n, t in out.dtypes) == SHAPES[name]


@pytest.mark.parametrize("name", ["op3_prefix_decontaminate", "op5_suffix_line_dedup", "op12_fill_in_middle"])
def test_same_rows_as_duckdb(spark, awkward, duck, name, write_tables):
    # SQL tells rows by id: one row per id
    seen, once = set(), []
    for row in awkward_rows():
        if row[0] is not None and row[0] not in seen:
            seen.add(row[0])
            once.append(row)
    path = write_tables(once) if name == "op5_suffix_line_dedup" else awkward
    got = registry.QUERIES[name](spark, path).toPandas()
    want = duck(path, registry.SQL[name])[list(got.columns)]
    plain = lambda df: sorted(
        str([v if isinstance(v, str) else int(v) for v in r]) for r in df.fillna(-1).itertuples(index=False, name=None)
    )
    assert plain(got) == plain(want)


def test_no_python_in_native_plans(spark, awkward):
    for name in ("op3_prefix_decontaminate", "op5_suffix_line_dedup"):
        plan = registry.QUERIES[name](spark, awkward)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_extra_columns_pass_through_the_stages(spark, awkward):
    import corpus_pipeline

    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, awkward)
        assert out.dtypes == docs.dtypes
        assert out.where(F.col("size") != "x").count() == 0
