"""Every exactly-checkable query against its DuckDB statement on the smallest tables."""

import math

import duckdb
import pytest

from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "events"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def _rows(records, cols):
    key = sorted(cols)
    rows = [tuple(_norm(r[c]) for c in key) for r in records]
    return sorted(rows, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _names():
    from shopflow import registry
    return sorted(registry.T2_QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E

    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [r.asDict() for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(srows, sdf.columns) == _rows(drows, dcols)


def test_every_query_has_a_statement():
    import __spark_entry__ as E
    from shopflow import registry

    assert set(registry.all_queries()) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and "user_item_count" in df.columns
