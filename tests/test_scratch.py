from types import SimpleNamespace

import pytest

from tillwise.sources import scratch
from tillwise.sources.scratch import materialise, materialise_by, open_files, scratch_root


def session(master, setting):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_the_folder_the_cluster_names_is_used():
    assert scratch_root(session("yarn", "hdfs://shared/dir/")) == "hdfs://shared/dir/tillwise/app-1"


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session("yarn", None))


def test_a_local_session_keeps_one_folder():
    local = session("local[2]", None)
    assert scratch_root(local) == scratch_root(local)


def test_materialised_frame_is_a_table(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    table = materialise(df, "test")
    assert table.dtypes == df.dtypes and table.count() == 100
    assert table.inputFiles()


def test_no_task_meets_two_values(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 5 < 4 THEN CAST(id % 5 AS INT) END AS part", "'x' AS name")
    table = materialise_by(df.repartition(6), "part", "test")
    assert table.columns == ["id", "name"]
    tasks = [{r[0] % 5 for r in rows} for rows in table.rdd.glom().collect()]
    assert len(tasks) > 1 and all(len(values) < 2 for values in tasks)
    assert sorted(r[0] for r in table.collect()) == list(range(1000))
    none = materialise_by(df.limit(0), "part", "test")
    assert none.count() == 0 and none.dtypes == table.dtypes


def test_rows_are_not_sorted_by_folder(spark, monkeypatch, tmp_path):
    """A sort of whole rows would spill; with more folders than files may be open the rows are the same."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before, writer, seen = spark.conf.get(setting), type(spark.range(1).write), []
    real = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda *a, **b: seen.append(spark.conf.get(setting)) or real(*a, **b))
    df = spark.range(600).selectExpr("id", "id % 9 AS part")
    for most in (64, 2):
        monkeypatch.setattr(scratch, "_OPEN", most)
        assert sorted(r.id for r in materialise_by(df, "part", "test").collect()) == list(range(600))
    assert seen == ["64", "2"] and spark.conf.get(setting) == before
    with pytest.raises(ZeroDivisionError), open_files(spark):
        1 / 0
    assert spark.conf.get(setting) == before
