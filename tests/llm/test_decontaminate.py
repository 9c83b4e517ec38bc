import pytest

from tests.llm.conftest import BENCHMARK, awkward_rows
from tillwise.llm import decontaminate


@pytest.mark.parametrize("short", [["river"], ["the children"], ["river", "the children", "capital of the"]])
def test_items_of_one_and_two_words_beside_longer_ones(spark, write_tables, duck, short):
    items = [(1, BENCHMARK), *[(10 + i, text) for i, text in enumerate(short)]]
    path = write_tables(awkward_rows(), items=items)
    got = decontaminate.op3_prefix_decontaminate(spark, path).toPandas()
    want = duck(path, decontaminate.SQL)[list(got.columns)]
    assert len(got) == len(awkward_rows())
    plain = lambda df: sorted(map(str, df.fillna(-1).astype({"doc_id": int}).itertuples(index=False, name=None)))
    assert plain(got) == plain(want)
