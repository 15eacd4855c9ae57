"""Every registered query against its DuckDB oracle on sf0.001 (exact)."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import rows_of
from tripflow.plans import oracle, registry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KEYS = sorted(oracle.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert rows_of(scols, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 741
