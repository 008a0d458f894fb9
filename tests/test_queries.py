import pytest

from poiweave.operators.components import connected_components
from poiweave.plans import catalog
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_duckdb(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, DATA).toPandas(), duck.execute(catalog.SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    form = lambda x: x[columns].astype(str).sort_values(columns).reset_index(drop=True)
    assert form(got).equals(form(want))


def test_components(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    rows = [(9, 8), (8, 7), (7, 6), (1, 2), (3, 3), (None, 4), (5, 4), (4, 10), (10, 5)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {6: 6, 7: 6, 8: 6, 9: 6, 1: 1, 2: 1, 4: 4, 5: 4, 10: 4}


def test_long_chain(spark):
    rows = [(k, k + 1) for k in range(60)]
    assert {r[1] for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()} == {0}
