"""Running totals, sequences, moving averages and trends.

Windows without a partition put all rows in one task, so they are only offered
over series that are aggregated first (months, ranked groups), whose length does
not grow with the facts; for ids over all rows see global_ids().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import cut

TO_HERE = (W.unboundedPreceding, W.currentRow)


def _over(keys, *order):
    return W.partitionBy(*keys).orderBy(*order)


def running_total(df: DataFrame, value: str, order: list, keys: list[str] | tuple = (), name: str = "running") -> DataFrame:
    """W1 and W2."""
    return df.withColumn(name, F.sum(value).over(_over(keys, *order).rowsBetween(*TO_HERE)))


def pareto(df: DataFrame, value: str, *ties: str, share: float = 80.0) -> DataFrame:
    """W3: rank by value, cumulative share in percent, and whether the row is among those that first reach the share."""
    order = _over((), F.col(value).desc(), *ties)
    df = df.withColumn("rank", F.row_number().over(order)).withColumn("cum_pct", 100 * F.sum(value).over(order.rowsBetween(*TO_HERE)) / F.sum(value).over(W.partitionBy()))
    before = F.coalesce(F.lag("cum_pct").over(W.orderBy("rank")), F.lit(0.0))
    return df.withColumn("vital", before < share)


def last_values(df: DataFrame, keys: list[str], order: str, *columns: str) -> DataFrame:
    """W5: for each key the last value of each column that is not null, by itself."""
    return df.groupBy(*keys).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns))


def sequence(df: DataFrame, keys: list[str], order: list, name: str = "seq") -> DataFrame:
    """W6."""
    return df.withColumn(name, F.row_number().over(_over(keys, *order)))


def group_ids(df: DataFrame, keys: list[str], name: str = "group_id") -> DataFrame:
    """W7: dense numbers of the sorted key combinations, nulls last. Numbers are given to the distinct combinations and joined back null-safely."""
    ids = global_ids(df.select(*keys).distinct(), keys, name)
    cond = None
    left, right = df.alias("l"), ids.alias("r")
    for k in keys:
        c = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        cond = c if cond is None else cond & c
    return left.join(right, cond, "left").select("l.*", F.col(f"r.{name}"))


def global_ids(df: DataFrame, order: list[str], name: str = "id", start: int | Column = 0) -> DataFrame:
    """W8 and SNK8: consecutive numbers over all rows by order, from start + 1 on, without a single-task sort.

    Rows are range-partitioned and numbered within each partition; the partitions' sizes, one row each, give the offsets.
    The partitioned rows are written once and read for both: ranges are sampled and joined anew in every plan, so sizes
    that are counted in a plan of their own are those of other partitions.
    """
    cols = [F.col(c).asc_nulls_last() for c in order]
    part = cut(df.repartitionByRange(*cols).withColumn("_gid_part", F.spark_partition_id()), "ranges")
    part = part.withColumn("_gid_n", F.row_number().over(W.partitionBy("_gid_part").orderBy(*cols)))
    sizes = part.groupBy("_gid_part").agg(F.count("*").alias("_gid_size"))
    offsets = sizes.withColumn("_gid_before", F.coalesce(F.sum("_gid_size").over(W.orderBy("_gid_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_gid_part", "_gid_before")
    first = start if isinstance(start, Column) else F.lit(start)
    return part.join(F.broadcast(offsets), "_gid_part").withColumn(name, first + F.col("_gid_before") + F.col("_gid_n")).drop("_gid_part", "_gid_n", "_gid_before")


def moving_average(df: DataFrame, value: str, order: str, n: int, name: str = "moving") -> DataFrame:
    """W9: centred over k = min(3, n // 3) rows of a series of n, null where the frame is not full; null for k < 2."""
    k = min(3, n // 3)
    if k < 2:
        return df.withColumn(name, F.lit(None).cast("double"))
    w = W.orderBy(order).rowsBetween(-(k // 2), (k - 1) // 2)
    return df.withColumn(name, F.when(F.count(value).over(w) == k, F.avg(value).over(w)))


def share_of_total(df: DataFrame, value: str, keys: list[str] | tuple = (), name: str = "share_pct") -> DataFrame:
    """W10: the total is an aggregate of its own, joined back, so no window holds all rows."""
    if keys:
        total = df.groupBy(*keys).agg(F.sum(value).alias("_t"))
        out = df.join(total, list(keys))
    else:
        out = df.crossJoin(F.broadcast(df.agg(F.sum(value).alias("_t"))))  # one row
    return out.withColumn(name, F.try_divide(F.col(value) * 100, F.col("_t"))).drop("_t")


def control_band(df: DataFrame, value: str, sigmas: float = 2.0) -> DataFrame:
    """W11: mean, bounds and whether the value is out of them."""
    s = df.agg(F.avg(value).alias("mean"), F.stddev(value).alias("_sd"))
    out = df.crossJoin(F.broadcast(s))  # one row
    out = out.withColumns({"upper": F.col("mean") + sigmas * F.col("_sd"), "lower": F.col("mean") - sigmas * F.col("_sd")}).drop("_sd")
    return out.withColumn("out_of_band", (F.col(value) > F.col("upper")) | (F.col(value) < F.col("lower")))


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """W12 of degree 1: one row with slope and intercept."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def quadratic_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """W12: one row with a, b, c of a*x*x + b*x + c by least squares: centred power sums in one aggregate, then the closed form."""
    m = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    centred = m.crossJoin(F.broadcast(m.agg(F.avg("x").alias("mx")))).withColumn("u", F.col("x") - F.col("mx"))
    u, v = F.col("u"), F.col("y")
    s = centred.agg(F.count("*").cast("double").alias("n"), F.first("mx").alias("mx"), *(F.sum(F.pow(u, F.lit(k))).alias(f"s{k}") for k in (2, 3, 4)), F.sum(v).alias("t0"), F.sum(u * v).alias("t1"), F.sum(u * u * v).alias("t2"))
    # With the sum of u zero the normal equations are three in a, b, c; b and c are eliminated.
    s = s.withColumn("a", F.expr("try_divide(t2 - s2 * t0 / n - s3 * t1 / s2, s4 - s2 * s2 / n - s3 * s3 / s2)"))
    s = s.withColumn("b0", F.expr("(t1 - a * s3) / s2")).withColumn("c0", F.expr("(t0 - a * s2) / n"))
    return s.select("a", F.expr("b0 - 2 * a * mx").alias("b"), F.expr("c0 - b0 * mx + a * mx * mx").alias("c"))


def of_maximum(df: DataFrame, value: str, name: str = "pct_of_max") -> DataFrame:
    """W13."""
    return df.crossJoin(F.broadcast(df.agg(F.max(value).alias("_m")))).withColumn(name, F.try_divide(F.col(value) * 100, F.col("_m"))).drop("_m")


def back_to_rows(df: DataFrame, keys: list[str], name: str, value: Column) -> DataFrame:
    """W14: a group's aggregate on each of its rows."""
    return df.join(df.groupBy(*keys).agg(value.alias(name)), keys, "left")


def duplicate_flag(df: DataFrame, keys: list[str], name: str = "is_duplicate") -> DataFrame:
    """W15: true for every row of a key combination that occurs more than once; null keys are equal."""
    many = df.groupBy(*keys).agg((F.count("*") > 1).alias(name))
    cond = None
    for k in keys:
        c = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        cond = c if cond is None else cond & c
    return df.alias("l").join(many.alias("r"), cond, "left").select("l.*", f"r.{name}")


def change(current: Column, previous: Column, higher_is_better: bool = True) -> Column:
    """W16 and QD11: struct(change, change_pct, trend)."""
    d = current - previous
    up, down = ("improved", "worsened") if higher_is_better else ("worsened", "improved")
    trend = F.when(d.isNull(), "neutral").when(d > 0, up).when(d < 0, down).otherwise("stable")
    pct = F.when(previous == 0, F.lit(0.0)).otherwise(F.bround(d / previous * 100, 2))
    return F.struct(F.bround(d.cast("double"), 2).alias("change"), F.when(d.isNotNull(), pct).alias("change_pct"), trend.alias("trend"))


def versus_previous(df: DataFrame, value: str, order: str, keys: list[str] | tuple = (), higher_is_better: bool = True) -> DataFrame:
    """W16: each row of a series against the one before."""
    w = _over(keys, order)
    return df.withColumn("comparison", change(F.col(value), F.lag(value).over(w), higher_is_better))
