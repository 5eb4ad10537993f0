"""Every registered query against its DuckDB oracle (sf0.001), like the driver."""

import hashlib

import pytest

import __spark_entry__ as E
from conftest import SF001, register_tables

SLOW = {"stream_validate", "stream_turnover", "stream_strict_late", "stream_strict_late_scan", "stream_chain",
        "stream_generic_fold", "generic_fold"}


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return repr(round(v, 9)) if isinstance(v, float) else repr(v)
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["total_amount", "event_id", "store_id", "begin_stream_aggregator",
                          "end_stream_aggregator"]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    if name in SLOW:
        pytest.skip("covered by test_streaming")
    register_tables(duck, SF001)
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = [tuple(r) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
