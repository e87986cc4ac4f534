"""Driver contract: entry() and oracle parity of every registered query (sf0.001)."""

import datetime as dt
import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_entry_one_row(spark):
    df = E.entry(spark)
    assert df.columns == ["nb_ventes", "volume_total_eur", "prix_median_eur", "prix_m2_median_eur"]
    rows = df.collect()
    assert len(rows) == 1 and rows[0].nb_ventes > 0


def test_every_query_matches_oracle(spark):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    bad = []
    for key in oracle:       # queries without SQL have tests of their own
        df = qs[key](spark, SF)
        got = _canon(df.columns, [tuple(r) for r in df.collect()])
        res = con.execute(oracle[key])
        exp = _canon([d[0] for d in res.description], res.fetchall())
        if got != exp:
            bad.append(key)
    assert bad == []
