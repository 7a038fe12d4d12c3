"""Queries against their SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from stranda.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")


def rows(names, values):
    order = sorted(range(len(names)), key=lambda k: names[k])
    plain = lambda x: None if x is None or isinstance(x, float) and math.isnan(x) else round(float(x), 6) if isinstance(x, float | int) else str(x)
    return sorted(repr([plain(v[k]) for k in order]) for v in values)


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, want.fetchall())


@needs_data
def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 18
