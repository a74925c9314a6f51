"""Every registered query with SQL gives DuckDB's rows."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()


def plain(df):
    df = df[sorted(df.columns)]
    rows = []
    for r in df.astype(object).itertuples(index=False):
        rows.append(repr(tuple(None if v is None or v != v or str(v) in ("NaT", "<NA>") else float(v) if isinstance(v, float) else int(v) if hasattr(v, "__index__") and not isinstance(v, bool) else str(v) for v in r)))
    return sorted(rows)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf, con, name):
    got, want = QUERIES[name](spark, sf).toPandas(), con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
