"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as contract
from check import near, values

QUERIES, SQL = contract.queries(), contract.oracle_sql()


def test_contract(spark):
    assert set(SQL) <= set(QUERIES)
    result = contract.entry(spark)
    assert result.columns == ["hour", "mean_Consommation_MW", "mean_Production_totale_MW"] and result.count() == 24


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = duck.execute(SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = values(got), values(want)
    assert len(a) == len(b)
    assert [x for x in zip(a, b) if x[0] != x[1] and not near(*x)] == []
