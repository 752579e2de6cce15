"""Every registered query against its SQL counterpart, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as catalog
from conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if value is None or isinstance(value, (str, bool)):
            return value
        return round(float(value), 6) + 0.0

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SMALL)
    result = duck.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, df.collect()) == comparable(columns, result.fetchall())


def test_entry(spark):
    assert catalog.entry(spark).count() == 20


@pytest.mark.parametrize("name", ["shuffled_batches", "hashed_batches", "negative_samples", "low_rank_factors", "low_rank_update", "random_unit_vectors"])
def test_runs(spark, name):
    assert catalog.queries()[name](spark, SMALL).count() > 0
