"""Hashes and identifiers of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import col


def record_hash(df, exclude: tuple[str, ...] = (), digits: int = 8) -> Column:
    """SF52: md5 of the record as JSON, columns in order of name, doubles rounded, lists sorted. Equal records have equal hashes."""
    parts = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        if f.name in exclude:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.bround(c.cast("double"), digits)
        elif isinstance(f.dataType, T.ArrayType) and not isinstance(f.dataType.elementType, (T.MapType, T.ArrayType)):
            c = F.array_sort(c)
        parts.append(c.alias(f.name))
    return F.md5(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).cast("binary"))


def document_id(*candidates: Column | str, payload: Column, prefix: str = "NO_BPIN_") -> Column:
    """SF53: the first candidate that is not blank, else the prefix and 16 digits of the payload's hash."""
    texts = [F.nullif(F.trim(col(c).cast("string")), F.lit("")) for c in candidates]
    return F.coalesce(*texts, F.concat(F.lit(prefix), F.substring(F.md5(payload.cast("binary")), 1, 16)))


def infrastructure_id(bpin: Column | str, bp: Column | str, i: Column) -> Column:
    """SF54: by BPIN, else by BP, else a random one (not the same in a second run)."""
    return F.when(col(bpin).isNotNull(), F.format_string("INF-BPIN-%s-%04d", col(bpin).cast("string"), i)).when(col(bp).isNotNull(), F.format_string("INF-%s-%d", col(bp), i)).otherwise(F.concat(F.lit("INF-GEN-"), F.substring(F.uuid(), 1, 8)))


def filled(df, at: Column | None = None):
    """SF55: texts without nulls, and when the record was loaded."""
    return df.na.fill("").withColumn("loaded_at", F.current_timestamp() if at is None else at)
