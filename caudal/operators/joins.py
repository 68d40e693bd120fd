"""Lookups, chains, keyword overlap and reconciliation.

No side is broadcast by hint unless its size is fixed: Spark broadcasts what it
sees to be under spark.sql.autoBroadcastJoinThreshold, and shuffles otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import keep_first, keep_last


def attach(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """JN1 and JN3: left join to a dimension of one row for each key; rows never multiply."""
    return df.join(dimension.dropDuplicates([key]), key, "left")


def match_as_text(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """JN2: inner join of keys compared as trimmed texts; the right key is dropped."""
    key = lambda c: F.trim(F.col(c).cast("string"))
    return left.withColumn("_k", key(left_key)).join(right.withColumn("_k", key(right_key)).drop(*([right_key] if right_key in left.columns else [])), "_k").drop("_k")


def lookup(df: DataFrame, source: DataFrame, key: str, value: str, name: str, order: str, last: bool = True) -> DataFrame:
    """JN4 (last wins) and JN5 (first wins): a map out of source, looked up for each row."""
    one = (keep_last if last else keep_first)(source.where(F.col(key).isNotNull()).select(key, value, order), [key], order)
    return df.join(one.select(key, F.col(value).alias(name)), key, "left")


def two_hops(df: DataFrame, first: DataFrame, second: DataFrame, key: str, middle: str) -> DataFrame:
    """JN6: df.key to middle by first, then middle to second's columns."""
    return df.join(first.select(key, middle).dropDuplicates([key]), key, "left").join(second.dropDuplicates([middle]), middle, "left")


def cascade(df: DataFrame, maps: list[tuple[DataFrame, str, str]], name: str) -> DataFrame:
    """JN7: the first of several maps (table, key, value) that has a value, tried in order after the column's own."""
    own = [F.col(name)] if name in df.columns else []
    out = df
    for i, (m, key, value) in enumerate(maps):
        out = out.join(m.select(F.col(key).alias(f"_k{i}"), F.col(value).alias(f"_v{i}")).dropDuplicates([f"_k{i}"]), F.col(key) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    filled = F.coalesce(*own, *(F.col(f"_v{i}") for i in range(len(maps))))
    return out.withColumn(name, filled).drop(*(f"_v{i}" for i in range(len(maps))))


def semi(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """JN8."""
    return df.join(other.select(key), key, "left_semi")


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """JN9: keys of either side that the other lacks, with the side; null keys count as lacking."""
    a = left.select(key).join(right.select(key), key, "left_anti").withColumn("side", F.lit("left"))
    b = right.select(key).join(left.select(key), key, "left_anti").withColumn("side", F.lit("right"))
    return a.union(b)


def any_key(left: DataFrame, right: DataFrame, left_keys: list[Column], right_keys: list[Column], left_id: str, right_id: str) -> DataFrame:
    """JN20: pairs (left_id, right_id) that share any of their keys; blanks are no keys."""
    keys = lambda cs: F.explode(F.array_distinct(F.filter(F.array(*(F.nullif(F.trim(c.cast("string")), F.lit("")) for c in cs)), lambda x: x.isNotNull())))
    a = left.select(F.col(left_id), keys(left_keys).alias("_k"))
    b = right.select(F.col(right_id), keys(right_keys).alias("_k"))
    return a.join(b, "_k").select(left_id, right_id).distinct()


def keyword_overlap(left: DataFrame, right: DataFrame, left_id: str, left_text: str, right_id: str, right_text: str, least: int = 2, shortest: int = 5) -> DataFrame:
    """JN16: for each left row the right row that holds most of its words, from `least` on; ties go to the smallest right id.

    Words have `shortest` letters at least; whole words are compared. Of a left text's words that the right side has,
    the least - 1 most frequent ones make no pairs: a pair that shares `least` words shares one of the others, too. So
    the commonest words are joined only by texts that have hardly any other, and the words of a pair are counted on it.
    """
    words = lambda c: F.filter(F.array_distinct(F.split(F.lower(F.col(c)), r"\s+")), lambda w: F.length(w) >= shortest)
    theirs = right.select(right_id, words(right_text).alias("_theirs"))
    b = theirs.select(right_id, F.explode("_theirs").alias("_w"))
    often = b.groupBy("_w").agg(F.count("*").alias("_n"))
    own = left.select(left_id, F.explode(words(left_text)).alias("_w")).join(often, "_w").groupBy(left_id).agg(F.sort_array(F.collect_list(F.struct("_n", "_w")), asc=False)["_w"].alias("_own"))
    own = own.where(F.size("_own") >= least)
    # Pairs are found by ids alone; the words come to those that are left.
    pairs = own.select(left_id, F.explode(F.slice("_own", least, F.size("_own"))).alias("_w")).join(b, "_w").select(left_id, right_id).distinct()
    hits = pairs.join(theirs, right_id).join(own, left_id).select(left_id, right_id, F.size(F.array_intersect("_own", "_theirs")).cast("long").alias("hits")).where(F.col("hits") >= least)
    return hits.groupBy(left_id).agg(F.max_by(F.struct(right_id, "hits"), F.struct(F.col("hits"), -F.col(right_id))).alias("_b")).select(left_id, f"_b.{right_id}", "_b.hits")


def corrected_amount(df: DataFrame, master: DataFrame, key: str, value: str, master_value: str, tolerance: float = 1.0) -> DataFrame:
    """JN18: the master's amount where it differs by more than the tolerance."""
    m = master.select(key, F.col(master_value).alias("_m")).dropDuplicates([key])
    off = F.abs(F.col("_m") - F.col(value)) > tolerance
    return df.join(m, key, "left").withColumns({"was_corrected": F.coalesce(off, F.lit(False)), "difference": F.when(off, F.col("_m") - F.col(value)), value: F.when(off, F.col("_m")).otherwise(F.col(value))}).drop("_m")


def first_of(candidates: list[DataFrame], left_id: str, right_id: str) -> DataFrame:
    """JN17: of several tables of (left_id, right_id) matches in order of priority the best for each left row; ties go to the smallest right id."""
    ranked = reduce(DataFrame.unionByName, (c.select(left_id, right_id, F.lit(i).alias("match_type")) for i, c in enumerate(candidates)))
    return ranked.groupBy(left_id).agg(F.min(F.struct("match_type", right_id)).alias("_b")).select(left_id, f"_b.{right_id}", "_b.match_type")


def only_candidate(left: DataFrame, right: DataFrame, left_id: str, right_id: str, on: list[str]) -> DataFrame:
    """JN17: pairs where the right side has just one row for the left row's keys."""
    one = right.groupBy(*on).agg(F.min(right_id).alias(right_id), F.count("*").alias("_n")).where("_n = 1").drop("_n")
    return left.join(one, on).select(left_id, right_id)
