"""Median of value / surface over the pairs of parcels, selected by blocks, against brute force."""

import math
import random

import pytest

from landsales.operators import selection


def _brute(sv, ss):
    ratios = []
    for p, v, a in sv:
        for q, s, b in ss:
            if p == q:
                ratios += [v / s] * (a * b)
    if not ratios:
        return 0, None
    ratios.sort()
    pos = (len(ratios) - 1) * 0.5
    lo, hi = ratios[math.floor(pos)], ratios[math.ceil(pos)]
    return len(ratios), lo + (hi - lo) * (pos - math.floor(pos))


def _got(spark, sv, ss):
    values = spark.createDataFrame(sv, "id_parcelle string, x double, w long")
    surfaces = spark.createDataFrame(ss, "id_parcelle string, s double, w long")
    row = selection.pair_median(values, surfaces).first()
    return row.n or 0, row.median


@pytest.mark.parametrize("grid", [1, 256])
def test_pair_median_exact(spark, monkeypatch, grid):
    monkeypatch.setattr(selection, "GRID", grid)
    rnd = random.Random(5)
    for trial in range(3):
        sv, ss = [], []
        for p in range(6):
            for _ in range(40 if p == 0 else rnd.randint(1, 5)):            # parcel 0 is busy
                sv.append((f"p{p}", rnd.randint(5000000, 40000000) / 100, rnd.randint(1, 3)))
            for _ in range(30 if p == 0 else rnd.randint(0, 4)):
                ss.append((f"p{p}", rnd.choice([15.0, 30.0, 45.0, 60.0, 62.5, 90.0, 120.0]), rnd.randint(1, 2)))
        sv += [("p0", 100000.0, 5), ("p1", 100000.0, 1 + trial)]             # ties across parcels
        assert _got(spark, sv, ss) == _brute(sv, ss)


@pytest.mark.parametrize("sv,ss", [
    ([("p", x, 1) for x in (1.0, 2.0, 1e6, 2e6)], [("p", 1.0, 1)]),                            # ranks that part
    ([("p", 1000.0, 3), ("p", 2000.0, 2), ("q", 500.0, 4)], [("p", 10.0, 2), ("p", 20.0, 1), ("q", 5.0, 3)]),
    ([("p", 0.01, 1), ("p", 9e12, 1)], [("p", 0.01, 1), ("p", 99999999.0, 1)]),                # widest amounts
    ([], [("p", 10.0, 1)]),
    ([("p", 1.0, 1)], [("q", 10.0, 1)]),                                                       # no pair
    ([("p", 3.0, 10**12)], [("p", 2.0, 5)]),                                                   # large weights
])
def test_edges(spark, sv, ss):
    if sv and sv[0][2] == 10**12:
        assert _got(spark, sv, ss) == (5 * 10**12, 1.5)
    else:
        assert _got(spark, sv, ss) == _brute(sv, ss)


def test_a_busy_parcel_is_not_listed(spark):
    """Of one parcel with 200 x 200 pairs only the blocks that meet the median are listed."""
    rnd = random.Random(2)
    sv = [("p", rnd.uniform(1e5, 1e6), 1) for _ in range(200)]
    ss = [("p", rnd.uniform(10.0, 200.0), 1) for _ in range(200)]
    spark.createDataFrame(sv, "id_parcelle string, x double, w long").createOrReplaceTempView("tv")
    spark.createDataFrame(ss, "id_parcelle string, s double, w long").createOrReplaceTempView("ts")
    listed = spark.sql(selection.with_ctes(selection.pair_values("p", "tv", "ts"), "SELECT count(*) AS n FROM p_x")).first().n
    blocks = spark.sql(selection.with_ctes(selection.pair_values("p", "tv", "ts"),
                                           "SELECT sum(CASE WHEN side = 0 THEN w ELSE 0 END) AS n FROM p_d")).first().n
    assert listed < 40_000 and blocks < 2_000
    assert _got(spark, sv, ss) == _brute(sv, ss)
