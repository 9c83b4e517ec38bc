"""Merged month sketches beside exact counts."""

from pyspark.sql import functions as F

from tillwise.plans import sketches


def facts(spark, n=60_000):
    """Customers known exactly: every month sees half of them, shifted."""
    return spark.range(n).select(
        F.expr("date_add(date'2021-01-15', cast(id % 24 as int) * 30)").alias("transaction_date"),
        F.expr("id * 7 % 9001").alias("customer_id"), F.expr("id % 40").alias("store_id"),
        F.expr("if(id % 5 = 0, null, id % 300)").alias("product_id"), F.expr("if(id % 50 = 0, -1, 1)").alias("quantity"),
    )


def test_months_merge_within_the_bound(spark, tmp_path):
    rows = facts(spark)
    kept = sketches.keep(spark, sketches.month_sketches(rows), str(tmp_path / "kept"))
    for guess, where in ((sketches.distinct_counts(kept).first(), "true"),
                         (sketches.distinct_counts(kept.where("month < '2022-01-01'")).first(), "transaction_date < '2022-01-01'")):
        for c in sketches.COUNTED:
            exact = rows.where("quantity > 0").where(where).select(c).where(F.col(c).isNotNull()).distinct().count()
            assert abs(guess[c] - exact) <= max(1, sketches.BOUND * sketches.standard_error() * exact)
    found = sketches.beside_exact(rows, kept).collect()
    assert len(found) == 6 and all(r.within for r in found)


def test_a_changed_month_is_refreshed_alone(spark, tmp_path):
    rows = facts(spark, 6000)
    kept = sketches.keep(spark, sketches.month_sketches(rows), str(tmp_path / "kept"))
    more = rows.limit(0).unionByName(spark.range(500).selectExpr(
        "date'2021-01-20' AS transaction_date", "id + 1000000 AS customer_id", "1L AS store_id", "2L AS product_id", "1 AS quantity"))
    undated = more.withColumn("transaction_date", F.lit(None).cast("date"))
    both = rows.unionByName(more)
    changed = sketches.month_sketches(both.where("transaction_date < '2021-02-01'").unionByName(undated))
    new = sketches.keep(spark, sketches.refreshed(kept, changed), str(tmp_path / "kept"))
    whole = sketches.month_sketches(both.unionByName(undated))
    assert new.count() == kept.count() + 1
    assert sketches.distinct_counts(new).first() == sketches.distinct_counts(whole).first()
    assert sketches.distinct_counts(kept.limit(0)).first()["customer_id"] in (0, None)
