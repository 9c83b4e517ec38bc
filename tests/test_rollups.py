"""Reports from the monthly roll-up beside those from the rows, after every change of the facts."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.test_sales import got, tables  # noqa: F401
from tillwise.plans import dashboards, rollups, sales
from tillwise.sources import snapshots, warehouse

REPORTS = {
    "monthly_trend": sales.monthly_trend, "revenue_by_category": sales.revenue_by_category, "top_products": sales.top_products,
    "revenue_by_region": sales.revenue_by_region, "channel_share": dashboards.channel_share,
    "returns_by_category": sales.returns_by_category, "payment_breakdown": sales.payment_breakdown,
}
SIDES = {"revenue_by_category": 1, "top_products": 1, "returns_by_category": 1, "revenue_by_region": 2}


def declared(rows):
    """Every stored column of the facts."""
    table = warehouse.STAR[warehouse.FACTS]
    missing = [f.name for f in table.stored if f.name not in rows.columns]
    return warehouse.to_declared(rows.withColumns({c: F.lit(None) for c in missing}), table)


def check(spark, root, target, given):
    facts, kept = warehouse.read_table(spark, root, warehouse.FACTS), rollups.read(spark, target)
    for name, report in REPORTS.items():
        side = [given[SIDES[name]]] if name in SIDES else []
        for cut, short in ((facts, kept), (sales.in_year(facts, 2023), rollups.in_year(kept, 2023))):
            want, have = report(cut, *side), getattr(rollups, name)(short, *side)
            assert have.columns == want.columns and got(have) == got(want), name


def test_reports_after_every_change(spark, tables, tmp_path):  # noqa: F811
    root, target = str(tmp_path / "star"), str(tmp_path / "rollup")
    rows = declared(tables[0])
    early = F.coalesce(F.col("transaction_date") < "2023-01-01", F.lit(True))
    warehouse.write_table(rows.where(early), root, warehouse.FACTS)
    assert rollups.refresh(spark, root, target) == ["2022-01", "2022-02", snapshots.NULL_PART]
    check(spark, root, target, tables)
    # appended rows: one month is new, one has a second folder
    later = rows.where(~early).unionByName(rows.where("transaction_id = 'T1'").withColumn("transaction_id", F.lit("T9")))
    warehouse.write_table(later, root, warehouse.FACTS, mode="append")
    assert rollups.refresh(spark, root, target) == ["2022-01", "2023-02"]
    check(spark, root, target, tables)
    assert rollups.refresh(spark, root, target) == []
    warehouse.replace_months(rows.where("transaction_id = 'T3'").withColumn("quantity", F.lit(-3)), root)
    assert rollups.refresh(spark, root, target) == ["2022-02"]
    check(spark, root, target, tables)
    # a whole new load drops months
    warehouse.write_table(rows.where("transaction_id = 'T4'"), root, warehouse.FACTS)
    assert rollups.refresh(spark, root, target) == ["2023-02"]
    check(spark, root, target, tables)
    assert rollups.read(spark, target).select(warehouse.MONTH).distinct().count() == 1


def test_large_dimensions(spark, tables, tmp_path, no_broadcast):  # noqa: F811
    root, target = str(tmp_path / "star"), str(tmp_path / "rollup")
    warehouse.write_table(declared(tables[0]), root, warehouse.FACTS)
    rollups.refresh(spark, root, target)
    check(spark, root, target, tables)


def test_no_facts_and_no_rollup(spark, tables, tmp_path):  # noqa: F811
    root, target = str(tmp_path / "star"), str(tmp_path / "rollup")
    with pytest.raises(FileNotFoundError):
        rollups.read(spark, target)
    assert rollups.refresh(spark, root, target) == []
    warehouse.write_table(declared(tables[0].limit(0)), root, warehouse.FACTS)
    assert rollups.refresh(spark, root, target) == []
    check(spark, root, target, tables)


def test_a_refresh_that_dies_is_done_again(spark, tables, tmp_path, monkeypatch):  # noqa: F811
    root, target = str(tmp_path / "star"), str(tmp_path / "rollup")
    warehouse.write_table(declared(tables[0]).where("transaction_id < 'T3'"), root, warehouse.FACTS)
    rollups.refresh(spark, root, target)
    before = got(rollups.read(spark, target))
    warehouse.write_table(declared(tables[0]), root, warehouse.FACTS)

    def die(*_):
        raise OSError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "commit", die)
        with pytest.raises(OSError):
            rollups.refresh(spark, root, target)
    assert sorted(map(str, got(rollups.read(spark, target)))) == sorted(map(str, before))
    rollups.refresh(spark, root, target)
    check(spark, root, target, tables)


def test_slicer_reads_the_year_of_the_rollup_alone(spark, tables, tmp_path):  # noqa: F811
    root, target = str(tmp_path / "star"), str(tmp_path / "rollup")
    warehouse.write_table(declared(tables[0]), root, warehouse.FACTS)
    rollups.refresh(spark, root, target)
    report = rollups.revenue_by_region(rollups.in_year(rollups.read(spark, target), 2023), tables[2])
    plan = plan_of(report)
    assert "PartitionFilters: [isnotnull(transaction_month" in plan and root not in plan
    files = report.inputFiles()
    assert files and all(f"{target}/data/" in f for f in files)
