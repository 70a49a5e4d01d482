"""Every query with an oracle returns the oracle's rows."""

import duckdb
import pandas as pd
import pytest

from contrata.plans import driver, files, more, registry

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def told(df):
    def value(v):
        if pd.isna(v):
            return "null"
        return f"{float(v):.6g}" if isinstance(v, int | float) and not isinstance(v, bool) else str(v)

    return sorted(tuple(value(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    got, wanted = registry.queries()[name](spark, DATA).toPandas(), con.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert told(got) == told(wanted)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert driver.contracts(spark, DATA).count() > 0
