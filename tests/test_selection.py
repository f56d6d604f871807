"""Quantiles and samples by radix selection, against numpy and a plain sort."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from annospark.operators import explore, selection


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(4)
    groups = {"ties": [5.0] * 900 + [7.0] * 100, "one": [3.25], "normal": rng.normal(size=2000).tolist(), "heavy": (rng.pareto(0.4, 1500) * 1e3).tolist(), None: [1.0, 2.0], "odd": [1.0, None, float("nan"), 4.0]}
    return groups, spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("none", None)], "k string, v double").repartition(7)


PROBS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def test_quantiles_by_key(spark, values):
    groups, df = values
    got = {r.k: r for r in selection.quantiles(df, ["k"], "v", PROBS).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        clean = np.array([v for v in vs if v is not None and v == v])
        for name, p in PROBS.items():
            assert got[k][name] == pytest.approx(np.quantile(clean, p), rel=1e-12), (k, name)


def test_quantiles_of_longs_equal_percentile(spark):
    df = spark.range(10_000).selectExpr("id % 3 as a", "id % 2 as b", "pmod(hash(id), 1000) as v")
    want = df.groupBy("a", "b").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in PROBS.items()])
    assert sorted(selection.quantiles(df, ["a", "b"], "v", PROBS).collect()) == sorted(want.collect())
    whole = selection.quantiles(df, [], "v", {"m": 0.5}).collect()
    assert [r.m for r in whole] == [df.agg(F.percentile("v", F.lit(0.5))).first()[0]]
    assert [r.m for r in selection.quantiles(df.limit(0), [], "v", {"m": 0.5}).collect()] == [None]
    assert selection.quantiles(df.limit(0), ["a"], "v", {"m": 0.5}).count() == 0


def test_no_range_holds_all_of_a_hot_key(spark):
    df = spark.range(40_000).selectExpr("'hot' as k", "hash(id) as v")
    plan = selection.order_statistics(df, ["k"], "v", F.array(F.struct(F.floor(F.col("_n") / 2).alias("at"))))
    assert plan.count() == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ranges as small as these would be joined
    try:
        ranged = df.repartitionByRange("k", "v").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(ranged) > 1 and max(r["count"] for r in ranged) < 20_000


def test_upper_median(spark):
    df = spark.createDataFrame([("a", 4.0), ("a", 1.0), ("a", 3.0), ("a", 2.0), ("b", 9.0), ("c", None)], "k string, v double")
    assert sorted(tuple(r) for r in selection.upper_median(df, "v", "k").collect()) == [("a", 3.0), ("b", 9.0)]


def chosen(rows, k, seed=42):
    return sorted(rows, key=lambda u: (hashlib.md5(f"{u}:{seed}".encode()).hexdigest(), u))[:k]


@pytest.mark.parametrize("k", [0, 1, 37, 2999, 3000, 5000])
@pytest.mark.parametrize("bucket", [1, 100_000])
def test_k_of_n_is_the_head_of_the_hash_order(spark, monkeypatch, k, bucket):
    monkeypatch.setattr(selection, "CUT_ROWS", bucket)
    df = spark.range(3000).withColumnRenamed("id", "uid").withColumn("x", F.lit(1))
    got = selection.k_of_n(df, k, "uid")
    assert got.columns == ["uid", "x"] and sorted(r.uid for r in got.collect()) == sorted(chosen(range(3000), k))


def test_k_of_n_with_repeated_and_null_keys(spark):
    rows = [("a", i) for i in range(50)] + [(None, i) for i in range(20)] + [("b", 1)] * 3
    df = spark.createDataFrame(rows, "uid string, x int")
    for k in (1, 30, 52, 60, 73):
        for parts in (1, 6):
            got = sorted(map(tuple, selection.k_of_n(df.repartition(parts), k, "uid").collect()), key=str)
            assert len(got) == k
            if parts > 1:
                assert got == before
            before = got
    assert selection.k_of_n(df, 53, "uid").where("uid is null").count() == 0


def test_a_fraction_is_cut_by_counts(spark):
    df = spark.range(1000).withColumnRenamed("id", "uid")
    assert sorted(r.uid for r in explore.sample(df, 0.25).collect()) == sorted(chosen(range(1000), 250))
