from pyspark.sql import functions as F

import os

import pytest

from quern.functions.dist import cut, discard, salted_lookup


@pytest.fixture(params=["10485760", "-1"])
def threshold(spark, request):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lookup_with_given_counts_and_null_keys(spark, threshold, monkeypatch):
    big = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(300)] + [(300, None)], "id long, k long")
    small = spark.createDataFrame([(i, i * 10) for i in range(200)], "k long, w long")
    want = {i: (10 if i % 3 else (i * 10 if i < 200 else None)) for i in range(300)} | {300: None}
    assert {r.id: r.w for r in salted_lookup(big, "k", small, rows_per_slice=20).collect()} == want
    counted = small.join(big.groupBy("k").agg(F.count("*").alias("n")), "k", "left")
    got = salted_lookup(big, "k", counted, rows_per_slice=20, counts="n")
    monkeypatch.setattr("quern.functions.dist.MOST_HOT", 0)  # more hot keys than may be broadcast
    assert {r.id: r.w for r in salted_lookup(big, "k", small, rows_per_slice=20).collect()} == want
    assert got.columns == ["k", "id", "w"] and {r.id: r.w for r in got.collect()} == want


def test_empty_lookup(spark):
    big, small = spark.createDataFrame([], "id long, k long"), spark.createDataFrame([], "k long, w long")
    assert salted_lookup(big, "k", small).count() == 0


def test_cut_and_discard(spark):
    t = cut(spark.range(5).withColumn("x", F.array(F.lit(None).cast("string"))))
    assert sorted(r.id for r in t.collect()) == list(range(5)) and cut(t.where("id > 9")).count() == 0
    path = t._written.removeprefix("file:")
    assert os.path.isdir(path)
    discard(t, None)
    assert not os.path.isdir(path)


def test_spread(spark):
    from quern.functions.dist import spread

    few = spark.range(100).coalesce(1)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread(few).count() == 100
    many = spark.range(0, 100, 1, 9)
    assert spread(many) is many
    grouped = many.groupBy((many.id % 7).alias("k")).count().coalesce(1)
    assert spread(grouped) is grouped
