"""Joins with busy keys: split into blocks, no row lost or doubled."""

import random

import pytest
from pyspark.sql import functions as F

from landsales.operators import hot_join as H
from landsales.plans import reports as R
from landsales.plans import load as L
from landsales.store import Store

from test_store import _sale, _write_year


@pytest.mark.parametrize("share", [1, 7, 10**6])
def test_equals_a_plain_join(spark, monkeypatch, share):
    monkeypatch.setattr(H, "SHARE_ROWS", share)
    rng = random.Random(share)
    left = [(rng.choice("aaab") if k % 3 else f"k{k % 9}", k) for k in range(90)] + [(None, -1)]
    right = [(rng.choice("aac") if k % 2 else f"k{k % 9}", k, k % 4) for k in range(80)] + [(None, -2, 0)]
    a = spark.createDataFrame(left, "key string, x long")
    b = spark.createDataFrame(right, "key string, y long, z long")
    got = H.hot_join(a, b, "key", "x", "y")
    assert got.columns == ["key", "x", "y", "z"]
    assert sorted(tuple(r) for r in got.collect()) == sorted((k, x, y, z) for k, x in left for q, y, z in right if k and k == q)


def test_a_busy_key_becomes_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "SHARE_ROWS", 10)
    a = spark.range(200).select(F.lit("hot").alias("key"), F.col("id").alias("x"))
    b = spark.range(50).select(F.lit("hot").alias("key"), F.col("id").alias("y"))
    assert H.busy_keys(a, "key", "n").first().n == 20 and H.busy_keys(b, "key", "n").first().n == 5
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = H.hot_join(a, b, "key", "x", "y")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "_i" in plan.split("SortMergeJoin", 1)[1][:80] and "_j" in plan.split("SortMergeJoin", 1)[1][:80]
        held = joined.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        assert sum(r["count"] for r in held) == 10_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_parcel_of_half_the_rows(spark, work, monkeypatch):
    monkeypatch.setattr(H, "SHARE_ROWS", 5)
    land = f"{work}/landing"
    _write_year(land, 2022, [_sale(str(k), "01/02/2022", str(1000 + k), plan="1" if k % 2 else str(k + 2), surf=str(10 + k))
                             for k in range(60)])
    store = Store(spark, f"{work}/hot")
    L.load(spark, store.root, land, [2022], log=lambda m: None)
    t = store.tables()
    assert R.sale_premises(t).count() == 30 * 30 + 30
    assert t["sale_parcel_types"].agg(F.sum("pair_n")).first()[0] == 930
    ratios = sorted([(1000 + a) / (10 + b) for a in range(1, 60, 2) for b in range(1, 60, 2)]
                    + [(1000 + a) / (10 + a) for a in range(0, 60, 2)])
    assert R.kpi(t).first().prix_m2_median_eur == (ratios[464] + ratios[465]) / 2
