import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tillwise.functions.numbers import ratio
from tillwise.operators import quality, ranking
from tillwise.operators.dedupe import keep_first
from tillwise.operators.joins import fits_broadcast, hot_keys, keep_known, look_up_large, null_unknown, sum_by_labels
from tillwise.operators.shares import histogram, share_of_total


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_keep_first_with_a_hot_and_a_null_key(spark):
    # A third of the rows share key 0, some have none.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("place"), (F.col("id") * 7).alias("payload"))
    df = df.repartition(8)
    first = keep_first(df, "k", ["place"])
    expected = df.toPandas().sort_values("place").drop_duplicates("k")
    assert rows(first.select("place", "payload")) == rows(
        spark.createDataFrame(expected[["place", "payload"]]))
    assert plan_of(first).count("WindowGroupLimit") == 2


@pytest.fixture
def facts(spark):
    return spark.range(900).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit("hot"))
        .otherwise(F.concat(F.lit("c"), F.col("id") % 20)).alias("k"),
        (F.col("id") % 5).alias("n"))


@pytest.fixture
def dimension(spark):
    keys = [("hot", "x"), (None, "y"), ("unused", "x")] + [(f"c{i}", "xyz"[i % 3]) for i in range(10)]
    return spark.createDataFrame(keys, "k string, label string")


def check_lookups(facts, dimension):
    known = {r.k for r in dimension.collect() if r.k}
    all_rows = facts.collect()
    repaired = null_unknown(facts, dimension, "k", F.col("transaction_id"))
    assert repaired.columns == facts.columns
    assert rows(repaired) == sorted(((r[0], r[1] if r[1] in known else None, r[2]) for r in all_rows), key=str)
    assert rows(keep_known(facts, dimension, "k")) == sorted((tuple(r) for r in all_rows if r[1] in known), key=str)


def check_sums(facts, dimension):
    measures = {"count": F.count("transaction_id"), "total": F.sum("n")}
    got = sum_by_labels(facts, dimension, "k", ["label"], measures)
    joined = facts.toPandas().merge(dimension.toPandas().dropna(), on="k").groupby("label")
    want = [(label, len(g), int(g["n"].sum())) for label, g in joined]
    assert rows(got) == sorted(want, key=str)


def test_lookups_small_dimension(facts, dimension):
    check_lookups(facts, dimension)
    check_sums(facts, dimension)


def test_lookups_large_dimension(facts, dimension, no_broadcast):
    assert not fits_broadcast(dimension)
    check_lookups(facts, dimension)
    check_sums(facts, dimension)
    # Nulls are spread in the join key itself, and facts are summed before they meet the dimension.
    assert "hashpartitioning(_match" in plan_of(null_unknown(facts, dimension, "k", F.col("transaction_id")))
    summed = plan_of(sum_by_labels(facts, dimension, "k", ["label"], {"n": F.count("n")}))
    assert summed.index("SortMergeJoin") < summed.index("partial_count")


@pytest.fixture
def two_fifths(spark):
    """20,000 rows: one key has two fifths of them, another is hot but unknown, some have none."""
    rest = F.concat(F.lit("c"), F.col("id") % 4000)
    key = F.when(F.col("id") % 5 < 2, F.lit("c7")).when(F.col("id") % 10 == 3, F.lit("gone")).when(F.col("id") % 50 == 4, None)
    return spark.range(20_000, numPartitions=4).select(F.col("id"), key.otherwise(rest).alias("k"))


@pytest.fixture
def big_side(spark):
    side = spark.range(4000).select(F.concat(F.lit("c"), F.col("id")).alias("k"), F.when(F.col("id") != 9, F.col("id")).alias("v"))
    return side.unionByName(spark.createDataFrame([(None, 1)], "k string, v long"))


def test_hot_keys_are_found_by_their_share(two_fifths):
    assert set(hot_keys(two_fifths, "k")) == {"c7", "gone"}
    assert hot_keys(two_fifths.where("k IS NULL"), "k") == [] and hot_keys(two_fifths.limit(0), "k") == []


@pytest.mark.parametrize("hot", [None, [], ["c7"], ["c7", "gone", "nowhere"]])
def test_hot_keys_change_no_row(two_fifths, big_side, no_broadcast, hot):
    got = look_up_large(two_fifths, big_side, "k", F.col("id"), hot)
    assert got.columns == ["id", "k", "v"]
    want = [(r.id, r.k, None if r.k in (None, "gone", "c9") else int(r.k[1:])) for r in two_fifths.collect()]
    assert rows(got) == sorted(want, key=str)
    with pytest.raises(ValueError, match="hot"):
        look_up_large(two_fifths, big_side, "k", F.col("id"), ["x"] * 65)


def test_hot_keys_are_spread_over_the_tasks_of_the_join(spark, two_fifths, big_side, no_broadcast):
    def sizes(hot):
        joined = look_up_large(two_fifths, big_side, "k", F.col("id"), hot).select(F.spark_partition_id().alias("task"))
        return sorted(r["count"] for r in joined.groupBy("task").count().collect())

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain, spread = sizes(None), sizes(hot_keys(two_fifths, "k"))
        plan = plan_of(look_up_large(two_fifths, big_side, "k", F.col("id"), ["c7"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sum(plain) == sum(spread) == 20_000 and len(spread) == 4
    assert plain[-1] > 3 * plain[1] and spread[-1] < 1.5 * spread[1]
    # the facts are read once, and shuffled once
    assert plan.count("Range (0, 20000") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_broadcast_is_judged_by_size(spark, tmp_path, dimension):
    small = str(tmp_path / "small")
    dimension.write.parquet(small)
    assert fits_broadcast(spark.read.parquet(small))
    assert not fits_broadcast(spark.range(10**9).select(F.col("id"), F.col("id").alias("b")))


@pytest.mark.parametrize("n", [2, 5, 7, 9, 12, 60])
def test_rank_quintiles_are_those_of_qcut(spark, n):
    # Two values only: ties are ranked by id.
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 2).alias("v")).repartition(4)
    cuts = ranking.rank_cuts(df, "k", ["v"])["v"]
    got = {r.k: r.b for r in df.select("k", ranking.bucket_by_cuts("v", "k", cuts).alias("b")).collect()}
    frame = pd.DataFrame({"k": range(n), "v": [i % 2 for i in range(n)]})
    want = pd.qcut(frame["v"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert got == dict(zip(frame["k"], want))


@pytest.fixture
def measured(spark):
    """20,000 rows: a measure of few values, one of them on half of the rows, and a spread one, some of it missing."""
    few = F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id") % 7).cast("int").alias("few")
    spread = F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(10**6)) / 100).cast("decimal(12,2)").alias("spread")
    return spark.range(20_000, numPartitions=4).select(F.format_string("c%05d", F.pmod(F.col("id") * 7919, F.lit(20_000))).alias("k"), few, spread)


def whole_cuts(df):
    frame = sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])
    out = {}
    for at, name in ((1, "few"), (2, "spread")):
        order = sorted(frame, key=lambda r: (r[at] is not None, r[at] or 0, r[0]))
        out[name] = [(order[b * (len(order) - 1) // 5][at], order[b * (len(order) - 1) // 5][0]) for b in (1, 2, 3, 4)]
    return out


@pytest.mark.parametrize(("sample", "sigmas"), [(4000, 6), (500, 6), (40, 6), (1, 6), (4000, 0), (10**6, 6)])
def test_selected_cuts_are_those_of_a_sort(measured, monkeypatch, sample, sigmas):
    monkeypatch.setattr(ranking, "_SIGMAS", sigmas)
    assert ranking.rank_cuts(measured, "k", ["few", "spread"], sample=sample) == whole_cuts(measured)


def test_cuts_are_selected_without_sorting_all_rows(measured, monkeypatch):
    sorted_rows, real = [], ranking._positions

    def spied(long):
        sorted_rows.append(long.count())
        return real(long)

    monkeypatch.setattr(ranking, "_positions", spied)
    ranking.rank_cuts(measured, "k", ["few", "spread"], sample=4000)
    # the sample, then what lies inside of eight brackets, ties or not
    assert len(sorted_rows) == 2 and sorted_rows[0] < 2 * 4400 and sorted_rows[1] < 0.5 * 2 * 20_000


def test_cuts_of_nothing(spark):
    assert ranking.rank_cuts(spark.range(0).selectExpr("id AS k", "id AS v"), "k", ["v"], sample=1) == {"v": []}


def test_first_rank_with_one_value_for_most(spark):
    df = spark.range(500).select(
        F.format_string("c%04d", "id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.col("id") / 10).otherwise(7).cast("decimal(10,2)").alias("v")).repartition(8)
    ranked = ranking.first_rank(df, "k", "v")
    frame = df.toPandas().sort_values("k")
    want = dict(zip(frame["k"], frame["v"].astype(float).rank(method="first").astype(int)))
    assert {r.k: r["rank"] for r in ranked.collect()} == want
    assert "SinglePartition" not in plan_of(ranked)


def test_histogram_bins(spark):
    df = spark.createDataFrame([(1.0,), (1.33,), (3.0,), (5.0,), (None,)], "x double")
    got = {r.bin: r.row_count for r in histogram(df, "x").collect()}
    assert len(got) == 20 and {b for b, n in got.items() if n} == {1, 2, 11, 20} and sum(got.values()) == 4


def test_histogram_of_one_value_and_of_none(spark):
    one = histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [(r.lower_edge, r.upper_edge, r.row_count) for r in one] == [
        (1.5, 1.75, 0), (1.75, 2.0, 0), (2.0, 2.25, 2), (2.25, 2.5, 0)]
    assert histogram(spark.createDataFrame([], "x double"), "x").count() == 0


def test_shares(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1.00), ('b', 2.00) AS t(k, v)")
    assert [str(r[0]) for r in df.orderBy("k").select(share_of_total("v")).collect()] == ["33.3", "66.7"]


def test_near_duplicates_lists_every_id(spark):
    people = [(f"C{i}", "ann o'neil" if i % 2 else "ANN O'NEIL", "07", "PC") for i in range(40)]
    people += [("D1", "Bob", "08", "PC"), ("C7", "ann o'neil", "07", "PC"), (None, "Ann O'Neil", "07", "PC")]
    # a name alone is not a person; one of phone and postcode is enough
    people += [("E1", "Cy", None, None), ("E2", "Cy", None, None), ("F1", "Di", None, "PD"), ("F2", "di", None, "PD")]
    df = spark.createDataFrame(people, "customer_id string, full_name string, phone string, postcode string")
    found = quality.near_duplicates(df).select("full_name", "phone", "postcode", "customer_id", "ids").collect()
    want = {("Ann O'Neil", "07", "PC", f"C{i}", 40) for i in range(40)}
    want |= {("Di", None, "PD", "F1", 2), ("Di", None, "PD", "F2", 2)}
    assert len(found) == 42 and {tuple(r) for r in found} == want


@pytest.mark.parametrize("kind", ["decimal(10,4)", "double"])
def test_ranks_use_all_digits(spark, kind):
    df = spark.sql(f"""SELECT k, CAST(v AS {kind}) AS v FROM VALUES
        ('a', '0.124'), ('b', '0.121'), ('c', '0.1229'), ('d', '0.5') AS t(k, v)""")
    ranked = ranking.first_rank(df, "k", "v")
    assert {r.k: r["rank"] for r in ranked.collect()} == {"b": 1, "c": 2, "a": 3, "d": 4}
    assert dict(ranked.dtypes)["v"] == kind
    tenth = spark.range(10).select(F.format_string("%02d", "id").alias("k"), (F.col("id") / 1000).cast(kind).alias("v"))
    cuts = ranking.rank_cuts(tenth, "k", ["v"])
    got = tenth.select("k", ranking.bucket_by_cuts("v", "k", cuts["v"]).alias("b")).orderBy("k").collect()
    assert [r.b for r in got] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_measures_without_a_common_type_are_refused(spark):
    df = spark.sql("SELECT 'a' AS k, CAST(1 AS DECIMAL(38,0)) AS x, CAST(1 AS DECIMAL(38,20)) AS y")
    with pytest.raises(TypeError, match="one by one"):
        ranking.rank_cuts(df, "k", ["x", "y"])


@pytest.mark.parametrize("size", ["decimal(10,2)", "decimal(22,2)", "decimal(32,2)", "decimal(38,2)"])
def test_ratio_rounds_the_true_quotient(spark, size):
    df = spark.sql(f"""SELECT CAST(n AS {size}) AS n, CAST(d AS {size}) AS d FROM VALUES
        ('12.34', '100'), ('-12.35', '100'), ('12.35', '-100'), ('12.3499', '100'), ('1', '0'), ('0', '3') AS t(n, d)""")
    exact = spark.sql(f"SELECT CAST('1234999.97' AS {size}) * 1 AS n, CAST('10000000' AS {size}) AS d")
    share = ratio(F.col("n") * F.lit(100), F.col("d"), 1).alias("r")
    assert [str(r.r) for r in df.select(share).collect()] == ["12.3", "-12.4", "-12.4", "12.4", "None", "0.0"]
    assert [str(r.r) for r in exact.select(share).collect()] == ["12.3"]
    assert df.select(share).dtypes == [("r", "decimal(28,1)")]


def test_sizes_as_settings_spell_them():
    from tillwise.operators.joins import _bytes

    assert [_bytes(s) for s in ("-1", "10485760b", "256k", "10MB", "1g", "64")] == [-1, 10485760, 262144, 10 << 20, 1 << 30, 64]


def test_duplicate_and_missing_keys(spark):
    df = spark.createDataFrame([("S1",), ("S1",), (None,), (None,), ("S2",)], "store_id string")
    assert rows(quality.duplicate_keys({"stores": df})) == [("stores", "S1", 2)]
    assert rows(quality.missing_keys({"stores": df})) == [("stores", 2)]


def test_price_lookup_takes_the_last_row_and_falls_back(spark, no_broadcast):
    from tillwise.operators.conform import look_up_price
    from tillwise.sources.feeds import ORDINAL

    products = spark.createDataFrame(
        [("P1", "£1.00", 1), ("P1", "2.00", 2), ("P2", "n/k", 3), ("P3", None, 4)],
        f"product_id string, sell_price string, {ORDINAL} int")
    sold = spark.createDataFrame(
        [(1, "P1"), (2, "P2"), (3, "P3"), (4, "P9"), (5, None)], "transaction_id int, product_id string")
    got = {r.transaction_id: str(r.unit_price) for r in look_up_price(sold, products).collect()}
    assert got == {1: "2.00", 2: "9.99", 3: "9.99", 4: "9.99", 5: "9.99"}
