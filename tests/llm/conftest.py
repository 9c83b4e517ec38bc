"""Small tables with every awkward case, written as the operators read them."""

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use for their own results
    T.StructField("size", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("hash", T.StringType()),
    T.StructField("taken", T.StringType()), T.StructField("score", T.StringType()), T.StructField("rank", T.StringType()),
])
ENGLISH = (
    "the people of the town went down to the river and the children were playing there with some boats that they "
    "had made out of paper while the older men talked about the weather and the price of corn in the market and "
    "nobody noticed that the water was rising until the first boats came back over the wall into the garden"
)
GERMAN = (
    "die leute aus der stadt gingen hinunter an den fluss und die kinder spielten dort mit booten die sie aus papier "
    "gemacht hatten während die alten über das wetter und den preis von korn auf dem markt sprachen und niemand "
    "merkte dass das wasser stieg bis die ersten boote über die mauer in den garten zurück kamen"
)
BENCHMARK = "what is the capital of the country that lies north of the great desert and west of the sea"


def awkward_rows():
    """(doc_id, text, lang, source)."""
    rows = [
        (1, ENGLISH, "en", "web"), (2, ENGLISH, "en", "web"), (3, ENGLISH.replace("corn", "rye"), "en", None),
        (4, GERMAN, "de", "books"), (5, GERMAN, "de", "books"), (5, GERMAN, "de", "books"), (6, None, None, "web"),
        (7, "", "en", "web"), (8, "   \n\t ", "en", None), (9, "12345 !!! 678", "de", "Ü"),
        (10, f"{ENGLISH[:120]} {BENCHMARK} and so on", "en", "web"), (11, BENCHMARK.upper(), "en", "web"),
        (12, "É", "fr", "books"), (None, ENGLISH[50:200], "en", "web"), (None, None, None, None),
        (13, ("lorem ipsum dolor sit amet " * 4000).strip(), "la", "web"), (14, "one two", "en", "web"),
        (15, f"{ENGLISH}\n\n{GERMAN}\n{BENCHMARK}", "en", "web"), (16, f"{GERMAN}\nshort line\n{ENGLISH}", "de", "web"),
        (17, "a\0b \U0001f600 ñandú ŒUVRE", "es", "web"),
    ]
    rows += [(100 + i, f"{ENGLISH} ending number {i} of many", "en", "hot") for i in range(12)]
    rows += [(200 + i, f"{GERMAN} und noch ein satz {i}", "de", f"s{i % 3}") for i in range(12)]
    return rows


def documents(spark, rows):
    more = [(i, t, la, s, None if t is None else len(t), "x", None, "y", "z", "w", "v") for i, t, la, s in rows]
    return spark.createDataFrame(more, DOCUMENTS)


@pytest.fixture(scope="session")
def write_tables(spark, tmp_path_factory):
    def write(rows, items=((1, BENCHMARK), (2, "capital of the"), (3, None), (4, ""), (1, BENCHMARK)), labels=()):
        path = str(tmp_path_factory.mktemp("tables"))
        documents(spark, rows).repartition(3).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        return path

    return write


@pytest.fixture(scope="session")
def awkward(write_tables):
    labels = [(i, 1, i % 2) for i in (1, 2, 3, 4, 5, 5, 7)] + [(None, 0, 1), (9, 1, None)]
    return write_tables(awkward_rows(), labels=labels)


@pytest.fixture(scope="session")
def empty(write_tables):
    return write_tables([], items=[])


@pytest.fixture(scope="session")
def duck():
    """Rows of a DuckDB statement over written tables."""
    import duckdb

    def run(path, sql):
        con = duckdb.connect()
        for name in ("documents", "benchmark", "labels"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'")
        return con.execute(sql).df()

    return run
