import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tillwise.operators import cleanse, conform, narrow, quality
from tillwise.plans import load
from tillwise.schemas import FOREIGN_KEYS, STAR
from tillwise.sources import feeds, keyindex, snapshots, warehouse
from tillwise.sources.feeds import ORDINAL, read_feed, write_feed
from tillwise.streaming import incremental

CUSTOMERS = '''customer_id,full_name,email,phone,region,postcode,signup_date,loyalty_member,age_group
C1,ANN O'NEIL,Ann@X.com,0700,Wales,W1,2021-03-04,True,18-25
C2,"de VRIES, ""bob""",,+44700,London,W2,2021-03-05,False,55+
C1,later copy,a@x.com,0701,Wales,W1,2021-03-04,True,18-25
C3,cy,NA,0702,Wales,W3,soon,True,18-25
C3,cy again,c@x.com,0703,Wales,W3,2021-03-06,True,18-25
'''
PRODUCTS = """product_id,product_name,category,description,sell_price,cost_price,supplier,in_stock,launch_date
P1,Lamp,  HOME & GARDEN ,,£5.99,,Acme,True,2020-01-01
P2,Tea,food & drink,Tea,9.99,4.10,Acme,False,2020-01-02
P3,Rug,Home & Garden,,call us,1.00,Acme,True,2020-01-03
P4,Mat,Sports,,,,Acme,True,2020-01-04
"""
STORES = """store_id,store_name,region,postcode,store_size_sqft,num_staff,manager_name,opening_date,is_flagship
S1,North,NW England,N1,2000,10,,12/03/2018,False
S2,South,Atlantis,N2,2001,11,Jo,2019-12-26,True
S3,East,Scotland,N3,2002,12,Jo,05/13/2019,True
S4,West,Wales,N4,2003,13,Jo,2019-01-01,True,one too many
"""
HEAD = ("transaction_id,transaction_date,customer_id,product_id,store_id,quantity,unit_price,discount_pct,"
        "total_value,payment_method,channel\n")
# The copy of T1 in the second file comes later; T2's first copy has an unknown product.
TRANSACTIONS = [
    HEAD + """T1,2022-01-05,C1,P1,S1,2,5.99,0.1,10.78,Card,In-Store
T2,2022-01-06,C1,P9,S1,1,1,0,1,Card,In-Store
T2,2022-01-07,C2,P2,S1,1,9.99,0,9.99,Cash,In-Store
T3,2022-02-01,C9,P2,S9,1,9.99,0,9.99,Card,In-Store
""",
    HEAD + """T1,2022-01-05,C2,P2,S2,1,9.99,0,9.99,Card,In-Store
T4,2022-02-30,C1,P1,S1,1,5.99,0,5.99,Card,In-Store
T5,2023-02-01,,P2,,-1,9.99,0,-9.99,Voucher,Online
T6,2023-02-01,C3,P4,S3,0,0,0,123456789.00,Voucher,In-Store
T7,2023-02-01,C3,P4,S3,0,0,0,0,Voucher,In-Store
""",
]


@pytest.fixture
def raw_dir(tmp_path):
    for name, text in (("customers", CUSTOMERS), ("products", PRODUCTS), ("stores", STORES)):
        folder = tmp_path / "raw" / name
        folder.mkdir(parents=True)
        (folder / "part-00000.csv").write_text(text, encoding="utf-8")
    folder = tmp_path / "raw" / "transactions"
    folder.mkdir()
    for i, text in enumerate(TRANSACTIONS):
        (folder / f"part-0000{i}.csv").write_text(text, encoding="utf-8")
    return str(tmp_path / "raw")


def rows(df, *columns):
    return sorted((tuple(str(v) if v is not None else None for v in r) for r in df.select(*columns).collect()), key=str)


EXPECTED_FACTS = [
    ("T1", "2022-01-05", "C1", "P1", "S1", "2", "10.78", "In-Store"),
    ("T2", "2022-01-07", "C2", "P2", "S1", "1", "9.99", "In-Store"),
    ("T3", "2022-02-01", None, "P2", None, "1", "9.99", "In-Store"),
    ("T5", "2023-02-01", None, "P2", None, "-1", "-9.99", "Online"),
    ("T7", "2023-02-01", "C3", "P4", "S3", "0", "0.00", "In-Store"),
]
FACT_COLUMNS = ["transaction_id", "transaction_date", "customer_id", "product_id", "store_id", "quantity",
                "total_value", "channel"]


def test_lenient_load(spark, raw_dir, tmp_path):
    loaded = load.load_star(spark, raw_dir, str(tmp_path / "star"))
    assert rows(loaded["customers"], "customer_id", "full_name", "email", "phone", "signup_date") == [
        ("C1", "Ann O'Neil", "ann@x.com", "0700", "2021-03-04"),
        ("C2", 'De Vries, "Bob"', None, "+44700", "2021-03-05"),
        ("C3", "Cy Again", "c@x.com", "0703", "2021-03-06")]
    assert rows(loaded["products"], "product_id", "category", "sell_price", "cost_price") == [
        ("P1", "Home & Garden", "5.99", "3.59"), ("P2", "Food & Drink", "9.99", "4.10"),
        ("P4", "Sports", None, None)]
    assert rows(loaded["stores"], "store_id", "region", "opening_date", "manager_name") == [
        ("S1", "North West", "2018-03-12", None), ("S2", "Atlantis", "2019-12-26", "Jo"),
        ("S3", "Scotland", "2019-05-13", "Jo")]
    assert rows(loaded["transactions"], *FACT_COLUMNS) == EXPECTED_FACTS
    for name, table in STAR.items():
        assert loaded[name].schema.names[: len(table.columns)] == table.columns

    feeds = load.read_feeds(spark, raw_dir)
    assert rows(load.all_rejected(feeds), "feed", "row_key", "reason") == [
        ("customers", "C3", "signup_date: unreadable"), ("products", "P3", "sell_price: unreadable"),
        ("stores", "S4", "row: malformed"),
        ("transactions", "T4", "transaction_date: unreadable"), ("transactions", "T6", "total_value: unreadable")]
    assert rows(load.load_audit(feeds, loaded), "feed", "raw_rows", "loaded_rows", "dropped") == [
        ("customers", "5", "3", "2"), ("products", "4", "3", "1"), ("stores", "4", "3", "1"),
        ("transactions", "9", "5", "4")]


def test_loading_again_changes_nothing(spark, raw_dir, tmp_path):
    root = str(tmp_path / "star")
    load.load_star(spark, raw_dir, root)
    again = load.load_star(spark, raw_dir, root)
    assert rows(again["transactions"], *FACT_COLUMNS) == EXPECTED_FACTS
    assert rows(warehouse.row_counts(again), "table_name", "row_count") == [
        ("customers", "3"), ("products", "3"), ("stores", "3"), ("transactions", "5")]


def test_large_dimensions_load_the_same(spark, raw_dir, tmp_path, no_broadcast):
    loaded = load.load_star(spark, raw_dir, str(tmp_path / "star"))
    assert rows(loaded["transactions"], *FACT_COLUMNS) == EXPECTED_FACTS


def test_strict_load_fails_on_the_first_bad_row(spark, raw_dir, tmp_path):
    with pytest.raises(Exception, match="rejected row, signup_date: unreadable"):
        load.load_star(spark, raw_dir, str(tmp_path / "star"), strict=True)


def test_strict_load_refuses_repeated_products(spark, raw_dir, tmp_path):
    feeds = {"products": read_feed(spark, "products", f"{raw_dir}/products")}
    feeds["products"] = feeds["products"].where("product_id <> 'P3'")
    load.load_dimensions(feeds, str(tmp_path / "once"), strict=True)
    feeds["products"] = feeds["products"].unionByName(feeds["products"])
    with pytest.raises(ValueError, match="P. comes 2 times"):
        load.load_dimensions(feeds, str(tmp_path / "twice"), strict=True)


def test_incremental_load_equals_the_batch(spark, raw_dir, tmp_path):
    root, landing, checkpoint = (str(tmp_path / n) for n in ("star", "landing", "checkpoint"))
    load.load_dimensions({n: read_feed(spark, n, f"{raw_dir}/{n}") for n in load.DIMENSIONS}, root)
    source = tmp_path / "raw" / "transactions"
    late = source / "part-00001.csv"
    text = late.read_text()
    late.rename(tmp_path / "held-back.csv")
    arguments = (spark, "transactions", str(source), landing, checkpoint, 1)
    incremental.land_feed(*arguments)
    assert incremental.landed(spark, "transactions", landing).count() == 4
    late.write_text(text)
    incremental.land_feed(*arguments)
    incremental.land_feed(*arguments)  # nothing new, nothing repeated
    landed = incremental.landed(spark, "transactions", landing)
    assert landed.count() == 9
    load.load_transactions(landed, root)
    assert rows(warehouse.read_table(spark, root, "transactions"), *FACT_COLUMNS) == EXPECTED_FACTS


def test_ordinal_is_narrow(spark, tmp_path):
    """The place of a file among the others, not its padded name: rows are shuffled and sorted with it."""
    for name in ("part-10.csv", "part-9.csv", "ärger 1.csv", "part-9-b.csv"):
        (tmp_path / name).write_text(STORES.splitlines()[0] + f"\n{name},x,Wales,W,1,1,,2019-01-01,True\n", encoding="utf-8")
    feed = read_feed(spark, "stores", str(tmp_path))
    assert dict(feed.dtypes)[ORDINAL] == "struct<file:int,split:bigint,row:bigint>"
    places = {r.store_id: r.file for r in feed.select("store_id", f"{ORDINAL}.file").collect()}
    key = feeds.in_path_order(F.concat(F.lit(f"{tmp_path.name}/"), "name"))
    by_name = spark.createDataFrame([(n,) for n in places], "name string").orderBy(key).collect()
    assert [r.name for r in by_name] == sorted(places, key=places.get) and sorted(places.values()) == [0, 1, 2, 3]


def test_ordinal_follows_files_and_lines(spark, tmp_path):
    folder = tmp_path / "stores"
    folder.mkdir()
    # The later file is the larger one, which a scan would take first; its number has one digit more.
    for name, ids in (("part-99999.csv", range(3)), ("part-100000.csv", range(3, 300))):
        lines = [STAR["stores"].columns, *[[str(i)] + [""] * 8 for i in ids]]
        (folder / name).write_text("\n".join(",".join(line) for line in lines) + "\n")
    feed = read_feed(spark, "stores", str(folder)).repartition(5)
    assert [int(r[0]) for r in feed.orderBy(ORDINAL).select("store_id").collect()] == list(range(300))


def test_feed_survives_a_round_trip(spark, tmp_path):
    cells = ['a "quoted" one', "  spaces ", "comma, inside", "£ and ü", "back\\slash", None]
    names = [f"S{i}" for i in range(len(cells))]
    df = spark.createDataFrame(list(zip(names, cells)), "store_id string, store_name string")
    df = df.select("store_id", "store_name", *[F.lit(None).cast("string").alias(c) for c in STAR["stores"].columns[2:]])
    write_feed(df.repartition(2), str(tmp_path / "stores"))
    back = read_feed(spark, "stores", str(tmp_path / "stores"))
    assert {r.store_id: r.store_name for r in back.collect()} == dict(zip(names, cells))


def test_tables_in_the_catalog(spark, raw_dir, tmp_path):
    root = str(tmp_path / "star")
    warehouse.drop_tables(spark)
    load.load_star(spark, raw_dir, root)
    warehouse.create_tables(spark, root)
    try:
        assert spark.table("transactions").count() == 5
        joined = "SELECT count(*) FROM transactions JOIN products USING (product_id) WHERE quantity > 0"
        assert spark.sql(joined).first()[0] == 3
        with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
            spark.sql("INSERT INTO stores (store_id) VALUES ('S123456')")
    finally:
        warehouse.drop_tables(spark)
    assert set(FOREIGN_KEYS.values()) < set(STAR)


def test_append_and_month_replacement(spark, raw_dir, tmp_path):
    root = str(tmp_path / "star")
    facts = load.load_star(spark, raw_dir, root)["transactions"]
    copy = str(tmp_path / "copy")
    for _ in range(2):
        warehouse.write_table(facts, copy, "transactions", mode="append")
    assert rows(warehouse.read_table(spark, copy, "transactions"), *FACT_COLUMNS) == EXPECTED_FACTS
    more = facts.where("transaction_id = 'T3'").withColumn("transaction_id", F.lit("T8"))
    warehouse.write_table(more, copy, "transactions", mode="append")
    january = facts.where(F.col("transaction_date") < datetime.date(2022, 2, 1))
    warehouse.replace_months(january, copy)
    left = warehouse.read_table(spark, copy, "transactions").groupBy("transaction_month").count()
    assert rows(left, "transaction_month", "count") == [("2022-01", "2"), ("2022-02", "2"), ("2023-02", "2")]


def test_replaced_table(spark, tmp_path):
    target = str(tmp_path / "derived")
    warehouse.replace_table(spark.range(5), target)
    warehouse.replace_table(spark.range(3).withColumn("more", F.lit(1)), target)
    got = warehouse.read_derived(spark, target)
    assert got.columns == ["id", "more"] and got.count() == 3
    with pytest.raises(Exception, match="no"):
        warehouse.replace_table(spark.range(9).select(F.raise_error(F.lit("no")).cast("string").alias("id")), target)
    assert warehouse.read_derived(spark, target).count() == 3


def test_columns_are_read_by_the_header(spark, raw_dir, tmp_path):
    folder = tmp_path / "shuffled"
    folder.mkdir()
    (folder / "part-0.csv").write_text("store_name,store_id,is_flagship,region,postcode,num_staff,store_size_sqft,opening_date,manager_name\n"
                                       "North,S1,True,Wales,N1,10.0,2000.0,2019-01-01 00:00:00,Jo\n")
    found = load.TYPERS["stores"](read_feed(spark, "stores", str(folder))).first()
    assert (found.store_id, found.store_name, found.num_staff, found.store_size_sqft) == ("S1", "North", 10, 2000)
    assert str(found.opening_date) == "2019-01-01" and found._reject is None
    (tmp_path / "short.csv").write_text("store_id,name\nS1,North\n")
    with pytest.raises(ValueError, match=r"missing columns \['store_name'.*unknown columns \['name'\]"):
        read_feed(spark, "stores", str(tmp_path / "short.csv"))


def unlike_files(folder, feed):
    """Files of one feed: columns in two orders, one file empty, one with its header only, a name with odd characters."""
    folder.mkdir()
    plain = STAR[feed].columns
    swapped = [*plain[1:], plain[0]]

    def line(n, names):
        return ",".join(f'"{c}, {n}"' for c in names)

    texts = {
        "part-2.csv": [line("header", plain).replace(", header", ""), line(2, plain), line(3, plain), "one cell"],
        "part-10.csv": ["", ",".join(swapped), line(10, swapped)],
        "part-1 [a]%20{b}.csv": [",".join(swapped), line(1, swapped)],
        "part-4.csv": [], "part-5.csv": [",".join(plain)],
    }
    for name, lines in texts.items():
        (folder / name).write_text("".join(f"{each}\n" for each in lines))
    return [[f"{c}, {n}" for c in plain] for n in (1, 2, 3, 10)]


def test_files_of_unlike_headers_are_one_feed(spark, tmp_path):
    want = unlike_files(tmp_path / "raw", "stores")
    for multiline in (False, True):
        feed = read_feed(spark, "stores", str(tmp_path / "raw"), multiline)
        got = feed.repartition(3).orderBy(ORDINAL).where("NOT _malformed").select(STAR["stores"].columns)
        assert [list(r) for r in got.collect()] == want
        assert [r._malformed for r in feed.collect()].count(True) == 1
    # as many scans as orders of columns
    assert plan_of(feed.select("*")).count("FileScan csv") == 2
    (tmp_path / "raw" / "part-3.csv").write_text("store_id,store_id\nS1,S1\n")
    with pytest.raises(ValueError, match=r"unknown columns \['store_id'\]"):
        read_feed(spark, "stores", str(tmp_path / "raw"))


def test_the_header_probe_leaves_the_session_alone(spark, tmp_path):
    (tmp_path / "long.csv").write_text("a,b\n" + "1,2\n" * 300_000)
    (tmp_path / "other.csv").write_text('"b",a\n1,2\n')
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    found = feeds.headers(spark, str(tmp_path))
    assert {h: len(f) for h, f in found.items()} == {("a", "b"): 1, ("b", "a"): 1}
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_files_of_unlike_headers_land_by_batches(spark, tmp_path):
    want = unlike_files(tmp_path / "raw", "stores")
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "stream")
    arguments = (spark, "stores", str(tmp_path / "raw"), landing, checkpoint, 2)
    incremental.land_feed(*arguments)
    incremental.land_feed(*arguments)
    got = incremental.landed(spark, "stores", landing).where("NOT _malformed").orderBy(ORDINAL).select(STAR["stores"].columns)
    assert [list(r) for r in got.collect()] == want


def test_batches_of_unlike_headers_equal_one_load(spark, raw_dir, tmp_path):
    lines = [line.split(",") for line in TRANSACTIONS[1].splitlines()]
    (tmp_path / "raw" / "transactions" / "part-00001.csv").write_text("".join(",".join(c[::-1]) + "\n" for c in lines))
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    whole = load.load_star(spark, raw_dir, one)["transactions"]
    load.load_dimensions({n: read_feed(spark, n, f"{raw_dir}/{n}") for n in load.DIMENSIONS}, many)
    incremental.load_new_files(
        spark, f"{raw_dir}/transactions", many, str(tmp_path / "landing"), str(tmp_path / "stream"), files_per_batch=1)
    by_batch = warehouse.read_table(spark, many, "transactions")
    assert whole.count() == 5
    assert rows(by_batch, *whole.columns) == rows(whole, *whole.columns)


def test_malformed_mark_under_any_projection(spark, tmp_path):
    lines = [",".join(STAR["stores"].columns), "S1" + "," * 9, "S2,two cells", "S3" + "," * 8]
    (tmp_path / "stores.csv").write_text("\n".join(lines) + "\n")
    feed = read_feed(spark, "stores", str(tmp_path / "stores.csv"))
    want = {"S1": True, "S2": True, "S3": False}
    assert {r.store_id: r._malformed for r in feed.collect()} == want
    assert {r.store_id: r._malformed for r in feed.select("store_id", "_malformed").collect()} == want


def test_line_breaks_inside_cells(spark, raw_dir, tmp_path):
    path = tmp_path / "raw" / "stores" / "part-00000.csv"
    path.write_text(STORES.replace("S2,South", 'S2,"South\nGate"'))
    broken = load.load_star(spark, raw_dir, str(tmp_path / "one"))
    whole = load.load_star(spark, raw_dir, str(tmp_path / "two"), multiline=True)
    assert [r[0] for r in whole["stores"].where("store_id = 'S2'").select("store_name").collect()] == ["South\nGate"]
    assert broken["stores"].where("store_id = 'S2'").count() == 0


def test_every_row_is_accounted_for(spark, raw_dir, tmp_path):
    root = str(tmp_path / "star")
    load.load_star(spark, raw_dir, root)
    found = {(r.feed, r.cause): r.row_count for r in load.accounting(spark, root).collect()}
    for feed, read, loaded in (("customers", 5, 3), ("products", 4, 3), ("stores", 4, 3), ("transactions", 9, 5)):
        lost = sum(n for (f, cause), n in found.items() if f == feed and cause not in ("read", "loaded"))
        assert (found[feed, "read"], found[feed, "loaded"], lost) == (read, loaded, read - loaded)
    assert rows(load.rejects(spark, root), "feed", "row_key", "reason") == [
        ("customers", "C1", "customer_id: repeated"), ("customers", "C3", "signup_date: unreadable"),
        ("products", "P3", "sell_price: unreadable"), ("stores", "S4", "row: malformed"),
        ("transactions", "T1", "transaction_id: repeated"), ("transactions", "T2", "product_id: unknown"),
        ("transactions", "T4", "transaction_date: unreadable"), ("transactions", "T6", "total_value: unreadable")]


def test_audits_are_taken_while_the_feeds_are_typed(spark, raw_dir, tmp_path, monkeypatch):
    root, scans = str(tmp_path / "star"), []
    real = load.materialise

    def spied(df, label):
        scans.append((label, plan_of(df).count("FileScan csv")))
        return real(df, label)

    monkeypatch.setattr(load, "materialise", spied)
    load.load_star(spark, raw_dir, root, audit=True)
    # each feed is scanned where it is typed and nowhere else
    assert [s for s in scans if s[1]] == [(f"typed-{n}", 1) for n in ("customers", "products", "stores", "transactions")]
    found, raw = load.audits(spark, root), load.read_feeds(spark, raw_dir)
    for name, report in (("missing_keys", quality.missing_keys), ("too_long", quality.too_long),
                         ("too_large", quality.too_large), ("defects", quality.defects)):
        want = report(raw)
        assert found[name].dtypes == want.dtypes
        assert rows(found[name], *want.columns) == rows(want, *want.columns)
    load.load_star(spark, raw_dir, root)
    assert load.audits(spark, root) == {}


def test_audits_of_empty_feeds(spark, raw_dir, tmp_path):
    raw = {n: df.limit(0) for n, df in load.read_feeds(spark, raw_dir).items()}
    root = str(tmp_path / "star")
    load.load_dimensions(raw, root, audit=True)
    found = load.audits(spark, root)["defects"]
    assert {(r.row_count, r.pct) for r in found.collect()} == {(0, None)}


def test_a_load_by_shuffle_sees_hot_keys(spark, raw_dir, tmp_path, no_broadcast, monkeypatch):
    seen = {}
    real = load.repair
    monkeypatch.setattr(load, "repair", lambda facts, c, s, hot: real(facts, c, s, seen.update(hot) or hot))
    whole = load.load_star(spark, raw_dir, str(tmp_path / "star"))["transactions"]
    assert whole.count() == 5 and set(seen) == set(FOREIGN_KEYS) and "P2" in seen["product_id"]


def test_a_failed_load_keeps_the_old_tables(spark, raw_dir, tmp_path):
    root = str(tmp_path / "star")
    load.load_star(spark, raw_dir, root)
    with pytest.raises(Exception, match="rejected row"):
        load.load_star(spark, raw_dir, root, strict=True)
    bad = warehouse.read_table(spark, root, "stores").withColumn("store_name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        warehouse.write_table(bad, root, "stores")
    assert rows(warehouse.row_counts({n: warehouse.read_table(spark, root, n) for n in STAR}), "row_count") == [
        ("3",), ("3",), ("3",), ("5",)]


def test_new_files_touch_their_months_only(spark, raw_dir, tmp_path):
    root, landing, checkpoint = (str(tmp_path / n) for n in ("star", "landing", "checkpoint"))
    load.load_dimensions({n: read_feed(spark, n, f"{raw_dir}/{n}") for n in load.DIMENSIONS}, root)
    source = tmp_path / "raw" / "transactions"
    late = source / "part-00001.csv"
    text = late.read_text()
    late.rename(tmp_path / "held-back.csv")
    incremental.load_new_files(spark, str(source), root, landing, checkpoint)
    assert warehouse.read_table(spark, root, "transactions").count() == 3
    before = snapshots.current(spark, root).tables["transactions"]
    late.write_text(text)
    incremental.load_new_files(spark, str(source), root, landing, checkpoint)
    incremental.load_new_files(spark, str(source), root, landing, checkpoint)  # nothing new
    assert rows(warehouse.read_table(spark, root, "transactions"), *FACT_COLUMNS) == EXPECTED_FACTS
    after = snapshots.current(spark, root).tables["transactions"]
    assert set(after) == {"2022-01", "2022-02", "2023-02"} and all(after[m] == before[m] for m in before)
    february = warehouse.read_table(spark, root, "transactions").where("transaction_month = '2023-02'")
    assert february.count() == 2 and "PartitionFilters: [isnotnull(transaction_month" in plan_of(february)


UNDATED = [
    HEAD + """T1,2022-01-05,C1,P1,S1,1,5.99,0,5.99,Card,In-Store
U1,,C1,P1,S1,1,5.99,0,5.99,Card,In-Store
T9,2022-13-45,C1,P1,S1,1,5.99,0,5.99,Card,In-Store
""",
    HEAD + """U2,,C2,P2,S2,2,9.99,0,19.98,Cash,In-Store
U1,,C2,P2,S2,1,9.99,0,9.99,Card,In-Store
U3,,C2,P9,S2,1,9.99,0,9.99,Card,In-Store
""",
]


def test_new_files_keep_rows_without_a_date(spark, raw_dir, tmp_path):
    root, landing, checkpoint = (str(tmp_path / n) for n in ("star", "landing", "checkpoint"))
    source = tmp_path / "raw" / "transactions"
    for old in source.iterdir():
        old.unlink()
    load.load_dimensions({n: read_feed(spark, n, f"{raw_dir}/{n}") for n in load.DIMENSIONS}, root)
    for i, text in enumerate(UNDATED):  # the second file has undated rows only
        (source / f"part-0000{i}.csv").write_text(text)
        incremental.load_new_files(spark, str(source), root, landing, checkpoint)
    got = rows(warehouse.read_table(spark, root, "transactions"), *FACT_COLUMNS)
    assert got == rows(load.load_star(spark, raw_dir, str(tmp_path / "whole"))["transactions"], *FACT_COLUMNS)
    assert [r[0] for r in got] == ["T1", "U1", "U2"]


def test_appending_rows_without_a_date_again_adds_none(spark, raw_dir, tmp_path):
    facts = load.load_star(spark, raw_dir, str(tmp_path / "star"))["transactions"]
    undated = facts.withColumn("transaction_date", F.lit(None).cast("date"))
    some = facts.where("transaction_id <> 'T1'").unionByName(undated.where("transaction_id = 'T1'"))
    copy = str(tmp_path / "copy")
    for more in (some, undated.where("transaction_id = 'T1'"), some):
        warehouse.write_table(more, copy, "transactions", mode="append")
    assert warehouse.read_table(spark, copy, "transactions").count() == 5


# Copies of T1 in other months, an unknown product, an unreadable date; files by name, in the order they arrive.
ARRIVALS = {
    "part-00005.csv": HEAD + """T1,2022-01-05,C1,P1,S1,2,5.99,0.1,10.78,Card,In-Store
T2,2022-01-06,C1,P2,S1,1,1,0,1,Card,In-Store
""",
    "part-00006.csv": HEAD + """T1,2022-02-05,C2,P2,S2,1,9.99,0,9.99,Card,In-Store
T3,2022-02-06,C2,P9,S2,1,9.99,0,9.99,Card,In-Store
T4,2022-02-30,C2,P2,S2,1,9.99,0,9.99,Card,In-Store
""",
    # stands before the others, so its T2 and T5 count once it is there
    "part-00001.csv": HEAD + """T2,2021-12-06,C2,P2,S2,3,9.99,0,29.97,Card,In-Store
T5,2021-12-07,C2,P2,S2,1,9.99,0,9.99,Card,In-Store
T2,2021-11-06,C2,P2,S2,3,9.99,0,29.97,Card,In-Store
""",
    "part-00009.csv": HEAD + """T5,2022-01-07,C2,P2,S2,1,9.99,0,9.99,Card,In-Store
T6,2022-01-08,C2,P2,S2,1,9.99,0,9.99,Card,In-Store
T1,,C2,P2,S2,1,9.99,0,9.99,Card,In-Store
""",
}


def test_any_order_of_arrival_gives_the_batch_load(spark, raw_dir, tmp_path):
    root, landing, checkpoint = (str(tmp_path / n) for n in ("star", "landing", "checkpoint"))
    source = tmp_path / "raw" / "transactions"
    for old in source.iterdir():
        old.unlink()
    load.load_dimensions({n: read_feed(spark, n, f"{raw_dir}/{n}") for n in load.DIMENSIONS}, root)
    for i, (name, text) in enumerate(ARRIVALS.items()):
        (source / name).write_text(text)
        incremental.load_new_files(spark, str(source), root, landing, checkpoint)
        if i < 2:
            continue
        load.load_star(spark, raw_dir, whole := str(tmp_path / f"whole-{i}"))
        for table in (lambda r: warehouse.read_table(spark, r, "transactions").select(FACT_COLUMNS),
                      lambda r: load.rejects(spark, r), lambda r: load.accounting(spark, r)):
            assert rows(table(root), *table(root).columns) == rows(table(whole), *table(whole).columns), name
    got = rows(warehouse.read_table(spark, root, "transactions"), "transaction_id", "transaction_date")
    assert got == [("T1", "2022-01-05"), ("T2", "2021-12-06"), ("T5", "2021-12-07"), ("T6", "2022-01-08")]


def test_a_batch_counts_once(spark, raw_dir, tmp_path, monkeypatch):
    """A batch that dies before its commit leaves nothing, one that runs again after it changes nothing."""
    root, landing, checkpoint = (str(tmp_path / n) for n in ("star", "landing", "checkpoint"))
    load.load_dimensions({n: read_feed(spark, n, f"{raw_dir}/{n}") for n in load.DIMENSIONS}, root)
    source, commit = str(tmp_path / "raw" / "transactions"), snapshots.commit
    before = snapshots.current(spark, root)

    def dies(spark, root, new):
        raise RuntimeError("killed before the commit")

    def dies_later(spark, root, new):
        commit(spark, root, new)
        raise RuntimeError("killed after the commit")

    for number, broken in enumerate((dies, dies_later)):
        monkeypatch.setattr(snapshots, "commit", broken)
        with pytest.raises(Exception, match="killed"):
            incremental.load_new_files(spark, source, root, landing, checkpoint)
        monkeypatch.setattr(snapshots, "commit", commit)
        assert (snapshots.current(spark, root) == before) == (number == 0)
    incremental.load_new_files(spark, source, root, landing, checkpoint)
    assert rows(warehouse.read_table(spark, root, "transactions"), *FACT_COLUMNS) == EXPECTED_FACTS
    found = {r.cause: r.row_count for r in load.accounting(spark, root).where("feed = 'transactions'").collect()}
    assert found.pop("read") == sum(found.values()) == 9


def test_a_killed_write_keeps_the_old_table(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "derived")
    warehouse.replace_table(spark.range(5), target)
    pinned = warehouse.read_derived(spark, target)
    folder, create = snapshots.write_folder, snapshots._file
    # before the data, after the data, and with a manifest cut short
    monkeypatch.setattr(snapshots, "write_folder", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        warehouse.replace_table(spark.range(3), target)
    monkeypatch.setattr(snapshots, "write_folder", folder)
    monkeypatch.setattr(snapshots, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        warehouse.replace_table(spark.range(3), target)
    monkeypatch.undo()
    assert create is snapshots._file and warehouse.read_derived(spark, target).count() == 5
    (tmp_path / "derived" / "manifests" / "1.json").write_text('{"tables": {"rows"')
    assert warehouse.read_derived(spark, target).count() == 5
    warehouse.replace_table(spark.range(3), target)
    assert warehouse.read_derived(spark, target).count() == 3 and pinned.count() == 5
    stale = snapshots.Manifest(0, {}, {})
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, target, stale)
    warehouse.replace_table(spark.range(2), target)
    deleted = snapshots.vacuum(spark, target, keep=1)
    assert len([d for d in deleted if "/data/" in d]) == 3 and warehouse.read_derived(spark, target).count() == 2


def test_only_buckets_that_may_hold_a_key_are_read(spark, tmp_path):
    root = str(tmp_path)
    entry = lambda ids, month: spark.createDataFrame(
        [(f"T{i}", None, month) for i in ids], keyindex.ENTRY)
    state = snapshots.Manifest()
    for at, month in enumerate(("2022-01", "2022-02", "2022-03")):
        state = keyindex.write(entry(range(1000 * at, 1000 * at + 1000), month), root).into(state)
    some = spark.createDataFrame([("T1500",), ("T7",), ("T9999999",)], "key string")
    parts = keyindex.touched(spark, root, state, some)
    folders = sum(map(len, parts.values()))
    assert len(parts) <= 3 and 2 <= folders <= 4 and sum(map(len, state.tables[keyindex.ENTRIES].values())) > 150
    assert rows(keyindex.lookup(spark, root, state, some), "key", "month") == [("T1500", "2022-02"), ("T7", "2022-01")]
    new = spark.range(50_000, 53_000).select(F.concat(F.lit("T"), "id").alias("key"))
    hit = keyindex.touched(spark, root, state, new)
    assert keyindex.lookup(spark, root, state, new).count() == 0
    assert sum(map(len, hit.values())) <= 3 * keyindex.BUCKETS
    # an earlier place takes over, and merging keeps one entry for each key
    earlier = spark.createDataFrame([("T7", ("a", 0, 5), "2020-01")], keyindex.ENTRY)
    for _ in range(keyindex.MOST_WRITES):
        state = keyindex.write(earlier, root).into(state)
    merged = keyindex.merged(spark, root, state)
    assert len(merged.notes[keyindex.ENTRIES]) == 1
    for s in (state, merged):
        assert rows(keyindex.lookup(spark, root, s, some), "key", "month") == [("T1500", "2022-02"), ("T7", "2022-01")]


def test_appending_an_id_of_another_month_adds_none(spark, raw_dir, tmp_path):
    root = str(tmp_path / "star")
    facts = load.load_star(spark, raw_dir, root)["transactions"]
    later = facts.where("transaction_id = 'T1'").withColumn("transaction_date", F.lit("2023-02-01").cast("date"))
    new = later.withColumn("transaction_id", F.lit("T50"))
    for _ in range(2):
        warehouse.write_table(later.unionByName(new), root, "transactions", mode="append")
    got = rows(warehouse.read_table(spark, root, "transactions"), "transaction_id")
    assert got == [("T1",), ("T2",), ("T3",), ("T5",), ("T50",), ("T7",)]
    warehouse.create_tables(spark, root)
    try:
        assert spark.table("transactions").count() == 6 and spark.table("stores").count() == 3
    finally:
        warehouse.drop_tables(spark)


def test_many_small_files_are_few_batches(spark, raw_dir, tmp_path, monkeypatch):
    """Files that wait together are batches of 1, 2, 4, ... files; after a crash the rest of them is loaded, each file once."""
    source = tmp_path / "raw" / "transactions"
    for old in source.iterdir():
        old.unlink()
    lines = [f"T{i},2022-01-0{i % 5 + 1},C1,P1,S1,1,5.99,0,5.99,Card,In-Store\n" for i in range(9)]
    for i, line in enumerate(lines):
        (source / f"part-0000{i}.csv").write_text(HEAD + line)
    root, landing, streams = (str(tmp_path / n) for n in ("star", "landing", "streams"))
    load.load_dimensions({n: read_feed(spark, n, f"{raw_dir}/{n}") for n in load.DIMENSIONS}, root)
    commit, sizes, read = snapshots.commit, [], incremental._rows_of
    monkeypatch.setattr(incremental, "_rows_of", lambda spark, feed, paths, m: sizes.append(len(paths)) or read(spark, feed, paths, m))

    def dies_at_the_third(spark, root, new):
        if len(sizes) == 3:
            raise RuntimeError("killed before the commit")
        return commit(spark, root, new)

    monkeypatch.setattr(snapshots, "commit", dies_at_the_third)
    for fill in (lambda: incremental.load_new_files(spark, str(source), root, f"{landing}-1", f"{streams}-1", files_per_batch=1),
                 lambda: incremental.land_feed(spark, "transactions", str(source), landing, f"{streams}-2", files_per_batch=1)):
        sizes.clear()
        with pytest.raises(Exception, match="killed"):
            fill()
        fill()
        fill()  # nothing new
        assert sizes == [1, 2, 4, 1, 2, 3]
    found = {r.cause: r.row_count for r in load.accounting(spark, root).where("feed = 'transactions'").collect()}
    assert found == {"read": 9, "loaded": 9}
    assert incremental.landed(spark, "transactions", landing).count() == 9


def test_a_batch_of_large_files_stays_small(monkeypatch):
    monkeypatch.setattr(incremental, "BATCH_BYTES", 100)
    files = [(f"f{i}", size) for i, size in enumerate([500, 500, 20, 20, 70, 70, 20, 5, 5, 5])]
    assert [[int(n[1:]) for n in some] for some in incremental._cut(files, 2)] == [[0, 1], [2, 3], [4, 5], [6, 7, 8, 9]]
    assert incremental._behind(snapshots.Manifest(notes={incremental.BATCHES: {"s": 3}}), "s", 3) >= 10  # a note of before
    assert list(incremental._cut([], 2)) == []


def test_whole_rows_are_shuffled_to_their_months_only(spark, raw_dir, tmp_path, no_broadcast, monkeypatch):
    plans, real = {}, load.written
    monkeypatch.setattr(load, "written", lambda df, root, name: plans.update({name: plan_of(df)}) or real(df, root, name))
    loaded = load.load_star(spark, raw_dir, str(tmp_path / "star"))
    assert rows(loaded["transactions"], *FACT_COLUMNS) == EXPECTED_FACTS
    assert set(plans) == set(STAR)
    for plan in plans.values():
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    feed = read_feed(spark, "transactions", f"{raw_dir}/transactions")
    # the names of files are looked up without a shuffle of the rows
    assert "SortMergeJoin" not in plan_of(feed)
    first = []
    monkeypatch.setattr(warehouse, "written", lambda df, root, name: first.append(plan_of(df)) or real(df, root, name))
    warehouse.write_table(loaded["transactions"], str(tmp_path / "new"), "transactions", mode="append")
    assert "Join" not in first[0]


def test_rows_are_marked_by_their_numbers(spark, monkeypatch):
    ids = [0, 1, 62, 63, 64, 4095, 4096, 5000, 2**33 + 5, 2**33 + 63, 5 * 2**33 + 70_000]
    some = [0, 63, 4095, 4096, 2**33 + 63, 5 * 2**33 + 70_000]
    every = spark.createDataFrame([(i, f"r{i}") for i in ids], f"{cleanse.ROW} long, name string")
    bits = cleanse.row_bits(spark.createDataFrame([(i,) for i in [*some, some[0]]], f"{cleanse.ROW} long"))
    for most, join in ((100, "BroadcastHashJoin"), (5, "SortMergeJoin")):
        monkeypatch.setattr(cleanse, "MARKED", most)
        found = cleanse.marked(every, bits, "hit", len(ids))
        assert found.columns == [*every.columns, "hit"]
        assert sorted(r[0] for r in found.where("hit").collect()) == some and found.count() == len(ids)
    none = cleanse.marked(every, cleanse.row_bits(every.limit(0)), "hit", len(ids))
    assert none.where("NOT hit").count() == len(ids)


def test_the_staged_feed_is_in_order(spark, tmp_path):
    """Sorted as numbers, the rows of the feed are those of the statement, in the order of their ordinals."""
    from tillwise.sources import retail_views

    spark.createDataFrame(
        [(o, 1 + o % 7, 50 - o % 9, 3, float(o), 10.5, 0.1, 0.0 if o % 3 else 0.02, "R", "F", datetime.date(1997, 1, 2))
         for o in (11, 108, 108, 5, 3, 24, 40, 97, 113, 7)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(
        [(o, o + 1, datetime.date(1997, 1, 1), "1-URGENT") for o in (11, 108, 5, 24, 97, 97)],
        "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    whole = retail_views.untouched_feed(spark, str(tmp_path), "transactions").orderBy(ORDINAL)
    found = retail_views.ordered_feed(spark, str(tmp_path), "transactions")
    assert whole.schema == found.schema and whole.count() == 14  # two orders of 97, three late copies
    assert whole.collect() == found.collect()
    plan = plan_of(found.select("*"))
    assert plan.count("FileScan") == 2 and "Union" not in plan
    write_feed(found, str(tmp_path / "feed"))
    assert all(p.name.endswith(".csv.gz") for p in (tmp_path / "feed").glob("part-*"))
    assert read_feed(spark, "transactions", str(tmp_path / "feed")).count() == 14


def test_facts_are_not_shuffled_to_their_months(spark, raw_dir, tmp_path, no_broadcast, monkeypatch):
    plans, real = [], snapshots.write_folder

    def seen(df, root, partition=None):
        if partition == warehouse.MONTH:
            plans.append(plan_of(df))
        return real(df, root, partition)

    monkeypatch.setattr(snapshots, "write_folder", seen)
    loaded = load.load_star(spark, raw_dir, str(tmp_path / "star"))["transactions"]
    copy = str(tmp_path / "copy")
    warehouse.write_table(loaded, copy, "transactions")
    warehouse.replace_months(loaded.where("transaction_date < DATE '2022-02-01'"), copy)
    # mixed rows still are
    warehouse.write_table(loaded.drop(warehouse.MONTH), str(tmp_path / "mixed"), "transactions")
    assert ["REBALANCE" in p for p in plans] == [False, False, False, True]
    assert rows(warehouse.read_table(spark, copy, "transactions"), *FACT_COLUMNS) == EXPECTED_FACTS


def test_batches_grow_fast_after_the_first_few():
    files = [(f"f{i:04}", 1) for i in range(600)]
    assert [len(some) for some in incremental._cut(files, 2)] == [2, 4, 8, 64, 512, 10]


def test_a_batch_writes_its_facts_by_month(spark, raw_dir, tmp_path, monkeypatch):
    """Rows of all months are shuffled to their months and for nothing else; the claims of a batch are not broadcast."""
    root, landing, checkpoint = (str(tmp_path / n) for n in ("star", "landing", "checkpoint"))
    load.load_dimensions({n: read_feed(spark, n, f"{raw_dir}/{n}") for n in load.DIMENSIONS}, root)
    plans, write, keep = {}, snapshots.write_folder, incremental.materialise
    monkeypatch.setattr(snapshots, "write_folder", lambda df, *a: plans.update({a[1:]: plan_of(df)}) or write(df, *a))
    monkeypatch.setattr(incremental, "materialise", lambda df, label: plans.update({label: plan_of(df)}) or keep(df, label))
    incremental.load_new_files(spark, str(tmp_path / "raw" / "transactions"), root, landing, checkpoint)
    facts = plans[(warehouse.MONTH,)]
    assert "REBALANCE" in facts and facts.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" in plans["batch-ruled"] and "BroadcastHashJoin" not in plans["batch-ruled"]
    assert rows(warehouse.read_table(spark, root, "transactions"), *FACT_COLUMNS) == EXPECTED_FACTS


def test_bits_are_with_the_driver_for_a_range_of_rows_at_a_time(spark, raw_dir, tmp_path, no_broadcast, monkeypatch):
    whole = load.load_star(spark, raw_dir, str(tmp_path / "whole"))
    asked, real, root = [], cleanse.marked, str(tmp_path / "star")
    monkeypatch.setattr(load, "PASS", 2)
    for module in (load, narrow):
        monkeypatch.setattr(module, "marked", lambda rows, bits, into, n: asked.append((into, n)) or real(rows, bits, into, n))
    loaded = load.load_star(spark, raw_dir, root)
    # the answers about products are joined by row number before any row is left out
    assert {n for into, n in asked if into != "_unsold"} <= {1, 2} and len([a for a in asked if a[0] == "_no_store_id"]) > 3
    for name, df in whole.items():
        assert rows(loaded[name], *df.columns) == rows(df, *df.columns) != []
    # one folder for each month, as the catalog needs
    assert {len(own) for own in snapshots.current(spark, root).tables["transactions"].values()} == {1}
    assert rows(load.rejects(spark, root), "feed", "row_key", "reason") == rows(load.rejects(spark, str(tmp_path / "whole")), "feed", "row_key", "reason")


def test_ranges_of_row_numbers(spark):
    ids = [*range(5), *range(2**33, 2**33 + 2), 3 * 2**33, *range(4 * 2**33, 4 * 2**33 + 3)]
    every = spark.createDataFrame([(i,) for i in ids], f"{cleanse.ROW} long")
    found = cleanse.row_ranges(every, 3)
    assert found == [(0, 2, 3), (3, 4, 2), (2**33, 3 * 2**33, 3), (4 * 2**33, 4 * 2**33 + 2, 3)]
    assert sum(every.where(F.col(cleanse.ROW).between(a, b)).count() == n for a, b, n in found) == 4
    assert cleanse.row_ranges(every.limit(0), 3) == []


def test_cleaning_shuffles_no_whole_row(spark, raw_dir, tmp_path, no_broadcast, monkeypatch):
    root, feed = str(tmp_path / "star"), read_feed(spark, "transactions", f"{raw_dir}/transactions")
    load.load_dimensions({n: read_feed(spark, n, f"{raw_dir}/{n}") for n in load.DIMENSIONS}, root)
    dimensions = {n: warehouse.read_table(spark, root, n) for n in load.DIMENSIONS}
    twice = feed.unionAll(feed)  # rows with equal ordinals: one of them is kept
    for most in (conform.PASS, 4):
        monkeypatch.setattr(conform, "PASS", most)
        found = conform.clean_transactions(twice, **dimensions)
        assert rows(found, *FACT_COLUMNS) == EXPECTED_FACTS and found.columns == STAR["transactions"].columns
        assert "Exchange hashpartitioning" not in plan_of(found) and "SortMergeJoin" not in plan_of(found)
    want = conform.conform_typed(cleanse.type_transactions(twice), **dimensions)
    assert found.dtypes == want.dtypes and rows(found, *found.columns) == rows(want, *want.columns)
