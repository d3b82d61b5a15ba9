"""Every registered query against its DuckDB oracle on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
from shelfscope.plans.queries import QUERIES  # noqa: E402

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle_sql():
    assert set(KEYS) <= set(entry.oracle_sql()) and set(KEYS) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, scratch, key):
    df = entry.queries()[key](spark, SF)
    out = f"{scratch}/oracle_{key}"
    df.write.mode("overwrite").parquet(out)
    con.execute(f"CREATE OR REPLACE TEMP TABLE o AS {entry.oracle_sql()[key]}")
    con.execute(f"CREATE OR REPLACE TEMP VIEW s AS SELECT * FROM read_parquet('{out}/*.parquet')")
    scols = sorted(r[0] for r in con.execute("DESCRIBE s").fetchall())
    ocols = sorted(r[0] for r in con.execute("DESCRIBE o").fetchall())
    assert scols == ocols
    cols = ", ".join(f'"{c}"' for c in scols)
    n_s = con.execute("SELECT count(*) FROM s").fetchone()[0]
    n_o = con.execute("SELECT count(*) FROM o").fetchone()[0]
    assert n_s == n_o
    diff = con.execute(f"SELECT count(*) FROM (SELECT {cols} FROM s EXCEPT ALL SELECT {cols} FROM o)").fetchone()[0]
    assert diff == 0


def test_entry_returns_the_mart(spark):
    from shelfscope.sources.schemas import MART_COLUMNS

    df = entry.entry(spark)
    assert df.columns == [c for c, _ in MART_COLUMNS]
    assert df.count() > 0
