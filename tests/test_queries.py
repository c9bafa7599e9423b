"""Every registered query of the core against its SQL on the smallest tables, and the defined forms."""

import glob
import os

import duckdb
import pytest

from galley.plans import catalogue

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def _plain(v):
    return None if v is None else f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_gives_what_its_sql_gives(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = duck.execute(catalogue.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    kinds = {d[0]: str(d[1]) for d in want.description}
    assert {c: TYPES[t] for c, t in got.dtypes} == kinds
    order = sorted(names)
    a = sorted(repr([_plain(r[c]) for c in order]) for r in got.collect())
    b = sorted(repr([_plain(r[names.index(c)]) for c in order]) for r in want.fetchall())
    assert a == b


def test_all_queries_without_sql_are_known():
    assert set(catalogue.QUERIES) - set(catalogue.SQL) == {"p3_found", "p3_normalised", "parent_dedup", "trim_boundary", "stream_refetch"}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
