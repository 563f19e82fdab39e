"""The driver's correctness gate in miniature: every query with an oracle
must match DuckDB on sf0.001 (row count, column names, value multiset)."""

import hashlib
import math

import duckdb
import pytest

from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows))
                        .encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _keys():
    import __spark_entry__ as e
    return sorted(e.oracle_sql())


@pytest.mark.parametrize("name", _keys())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as e
    df = e.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(e.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "container_power_watts" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())
