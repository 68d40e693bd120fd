"""Exact quantiles without holding a group's values in one task.

The values are counted, dealt out by ranges of (keys, value), and ranked: within a
partition by a running sum, between partitions by the sums of those before, of
which a key has at most one for each partition. A quantile then is the one or two
rows that hold its rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def quantiles(df: DataFrame, keys: list[str], value: str, names: dict[str, float]) -> DataFrame:
    """keys and, under each name, the quantile of that fraction of value (number): linear between the two nearest ranks, as F.percentile.

    Nulls count for nothing; a key without values has no row. Null keys are keys.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    part = counted.repartitionByRange(*(F.col(c) for c in (*keys, "_v"))).withColumn("_part", F.spark_partition_id())
    sums = part.groupBy(*keys, "_part").agg(F.sum("_c").alias("_size"))
    by_key = W.partitionBy(*keys)
    sums = sums.withColumns({"_n": F.sum("_size").over(by_key), "_before": F.coalesce(F.sum("_size").over(by_key.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))})
    same = F.col("l._part") == F.col("r._part")
    for c in keys:
        same &= F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    ranked = part.withColumn("_up_to", F.sum("_c").over(W.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)))
    ranked = ranked.alias("l").join(sums.alias("r"), same).select("l.*", "r._n", "r._before").withColumn("_up_to", F.col("_up_to") + F.col("_before"))

    def at(rank):
        """The value of a rank, counted from 0."""
        return F.max(F.when((rank < F.col("_up_to")) & (rank >= F.col("_up_to") - F.col("_c")), F.col("_v")))

    out = {}
    for name, fraction in names.items():
        where = (F.col("_n") - 1) * F.lit(fraction)
        low, high = at(F.floor(where)), at(F.ceil(where))
        spot = (F.max("_n") - 1) * F.lit(fraction)
        out[name] = F.when(F.floor(spot) == F.ceil(spot), low).otherwise((F.ceil(spot) - spot) * low + (spot - F.floor(spot)) * high)
    return ranked.groupBy(*keys).agg(*(v.alias(k) for k, v in out.items()))


def with_quantiles(out: DataFrame, df: DataFrame, keys: list[str], value: str, names: dict[str, float]) -> DataFrame:
    """out, which has a row for each of keys (or a single row), with quantiles of df's value; null for keys without values."""
    if not keys:
        out, df, keys = out.withColumn("_all", F.lit(1)), df.withColumn("_all", F.lit(1)), ["_all"]
    found = quantiles(df, keys, value, names)
    same = F.lit(True)
    for c in keys:
        same &= F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return out.alias("l").join(found.alias("r"), same, "left").select("l.*", *(F.col(f"r.{n}") for n in names)).drop("_all")
