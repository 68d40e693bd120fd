"""Exact quantiles against Spark's own, which hold all values."""

import pytest
from pyspark.sql import functions as F

from caudal.operators import aggregates, quantiles


@pytest.mark.parametrize("keys", [["g"], ["g", "h"], []])
def test_quantiles(spark, keys):
    df = spark.range(5000).selectExpr("nullif(id % 7, 6) as g", "cast(id % 2 as string) as h", "if(id % 11 = 0, null, round(pow(rand(3), 3) * 100, 1)) as v")
    df = df.union(spark.createDataFrame([(100, "x", 1.0), (101, "x", None), (102, "y", -5.0), (102, "y", 7.0)], df.schema)).cache()
    names = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    want = df.groupBy(*keys).agg(*(F.percentile("v", F.lit(f)).alias(n) for n, f in names.items()))
    out = quantiles.with_quantiles(df.groupBy(*keys).agg(F.count("*").alias("n")).drop("n") if keys else df.agg(F.count("*").alias("n")), df, keys, "v", names).drop("n")
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect()))


def test_no_values(spark):
    df = spark.createDataFrame([], "g int, v double")
    assert aggregates.describe_by(df, ["g"], "v").collect() == []
    assert aggregates.moments(df, [], "v").select("n", "median", "q1").collect() == [(0, None, None)]


def test_one_key_spans_partitions(spark):
    """The ranks of one group come from several tasks."""
    df = spark.range(100_000).selectExpr("1 as g", "cast(id as double) as v")
    assert quantiles.quantiles(df, ["g"], "v", {"m": 0.5, "p": 0.999}).collect()[0][1:] == (49999.5, 0.999 * 99_999)
