"""Exact distributed percentile against a direct computation."""

import math
import random
from decimal import Decimal

from landsales.operators import selection


def median_double(df, value, weight=None):
    return selection.median(df, value, weight).first().median


def median_decimal(df, value):
    rows = selection.median(df, value)
    return rows.selectExpr(f"{selection.cents_between('lo', 'hi')} AS m").first().m


def _ref(values):
    v = sorted(values)
    if not v:
        return None
    pos = (len(v) - 1) * 0.5
    lo, hi = v[math.floor(pos)], v[math.ceil(pos)]
    return lo + (hi - lo) * (pos - math.floor(pos))


def test_decimal_half_cent_truncated(spark):
    df = spark.createDataFrame([(Decimal("1.25"),), (Decimal("2.50"),)], "v decimal(15,2)")
    assert median_decimal(df, "v") == Decimal("1.87")


def test_double_interpolates(spark):
    df = spark.createDataFrame([(1.25,), (2.5,)], "v double")
    assert median_double(df, "v") == 1.875


def test_empty(spark):
    df = spark.createDataFrame([], "v double")
    assert median_double(df, "v") is None


def test_weights_and_random(spark):
    rnd = random.Random(7)
    for n in [1, 2, 5, 200, 3001]:
        vals = [rnd.choice([rnd.uniform(-50, 1e6), 3.0, 0.0, 1e-9]) for _ in range(n)]
        w = [rnd.randint(1, 4) for _ in range(n)]
        df = spark.createDataFrame(list(zip(vals, w)), "v double, w long")
        expanded = [v for v, k in zip(vals, w) for _ in range(k)]
        assert median_double(df, "v", "w") == _ref(expanded)


def test_refinement_level_is_exact(spark, monkeypatch):
    monkeypatch.setattr(selection, "FINE", 2)      # coarse buckets: every level has work
    monkeypatch.setattr(selection, "PARTS", 8)
    rnd = random.Random(11)
    vals = [rnd.uniform(100.0, 101.0) for _ in range(4000)] + [rnd.uniform(1, 1e6) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert median_double(df, "v") == _ref(vals)
    dvals = [Decimal(rnd.randint(10000, 10100)) / 100 for _ in range(3001)]
    ddf = spark.createDataFrame([(d,) for d in dvals], "v decimal(15,2)")
    s = sorted(dvals)
    assert median_decimal(ddf, "v") == s[1500]


def test_middle_ranks_in_two_buckets(spark):
    for values in ([1.0, 2.0, 1000.0, 2000.0], [1.0] * 5 + [1e9] * 5, [-4.0, -2.0, 0.0, 3.0]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert median_double(df, "x") == _ref(values)


def test_the_selection_runs_only_at_an_action(spark):
    seen = spark.sparkContext.accumulator(0)
    df = spark.range(50).mapInPandas(lambda batches: (seen.add(1) or b for b in batches), "id long")
    made = selection.median(df, "id")
    assert seen.value == 0 and made.first().median == 24.5 and seen.value > 0


def test_windows_see_buckets_only(spark):
    plan = selection.median(spark.range(1000).selectExpr("id * 1.5D AS x"), "x")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
