"""Every query with an SQL twin gives the same rows as DuckDB on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(frame):
    def value(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    return sorted((str(tuple(value(v) for v in r)) for r in frame[sorted(frame.columns)].itertuples(index=False)))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_same_rows(spark, duck, name):
    ours = __spark_entry__.queries()[name](spark, SF).toPandas()
    result = duck.execute(__spark_entry__.oracle_sql()[name])
    theirs = pd.DataFrame(result.fetchall(), columns=[c[0] for c in duck.description], dtype=object)
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours.astype(object)) == normal(theirs)
