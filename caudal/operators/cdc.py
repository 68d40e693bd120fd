"""Change data capture and keyed upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import record_hash

NEW, MODIFIED, UNCHANGED = "NEW", "MODIFIED", "UNCHANGED"


def classify(new: DataFrame, old: DataFrame, key: str, exclude: tuple[str, ...] = (), force: Column | None = None) -> DataFrame:
    """CD1, CD2 and JN21: new's rows with their change: by hash of the columns that both sides have.

    A null key is NEW. force: a condition over new's columns (and old's with _old_ before) that makes a row MODIFIED. Of stored rows with one key any one counts.
    """
    shared = [c for c in new.columns if c in old.columns and c != key and c not in exclude]
    stored = old.select(F.col(key).alias("_key"), record_hash(old.select(*shared)).alias("_hash"), *(F.col(c).alias(f"_old_{c}") for c in (shared if force is not None else []))).where(F.col("_key").isNotNull()).dropDuplicates(["_key"])
    joined = new.withColumn("_own", record_hash(new.select(*shared))).join(stored, F.col(key) == F.col("_key"), "left")
    forced = F.coalesce(force, F.lit(False)) if force is not None else F.lit(False)
    label = F.when(F.col("_key").isNull(), NEW).when(forced | (F.col("_own") != F.col("_hash")), MODIFIED).otherwise(UNCHANGED)
    return joined.withColumn("change", label).select(*new.columns, "change")


def geometry_gained(new_type: str = "geometry_type", old_type: str = "_old_geometry_type") -> Column:
    """CD1: a geometry that was not there, or is of another type."""
    return F.col(new_type).isNotNull() & ~F.col(new_type).eqNullSafe(F.col(old_type))


def changed(classified: DataFrame) -> DataFrame:
    """CD3."""
    return classified.where(F.col("change") != UNCHANGED)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """CD4, CD5 and SNK6: old with new's rows in place of those with their key; missing columns are null."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def merge_fields(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """SNK10: field by field: new's value if it is not null, else old's."""
    cols = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c != key]
    side = lambda s, c, df: F.col(f"{s}.{c}") if c in df.columns else F.lit(None)
    both = old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    return both.select(F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key), *(F.coalesce(side("n", c, new), side("o", c, old)).alias(c) for c in cols))


def changelog(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """CD6 and SNK11: a row for each field that differs: key, field, old_value, new_value as text."""
    both = old.alias("o").join(new.alias("n"), key)
    each = F.array(*(F.when(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")), F.struct(F.lit(c).alias("field"), F.col(f"o.{c}").cast("string").alias("old_value"), F.col(f"n.{c}").cast("string").alias("new_value"))) for c in columns))
    return both.select(key, F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x")).select(key, "x.*")


def verify(expected: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """CD7: one row: rows of either side and keys that are missing."""
    missing = expected.select(key).join(stored.select(key), key, "left_anti").agg(F.count("*").alias("missing"))
    return expected.agg(F.count("*").alias("expected")).crossJoin(stored.agg(F.count("*").alias("stored"))).crossJoin(missing)  # one row each


def geometry_flags(df: DataFrame, column: str = "geometry") -> DataFrame:
    """CD8."""
    return df.withColumns({"has_geometry": F.col(column).isNotNull(), "geometry_type": F.col(f"{column}.type")})
