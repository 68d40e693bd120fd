"""Lists, references, JSON and maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import col

NULL_WORDS = ("", "nan", "null", "none")


def comma_list(c: Column | str) -> Column:
    """NJ1: trimmed parts, empty ones left out; null stays null."""
    return F.filter(F.transform(F.split(col(c), ","), lambda x: F.trim(x)), lambda x: x != "")


def references(c: Column | str) -> Column:
    """NJ2: always an array: of a JSON list, of a comma list (addresses of the web are not cut), or of one text; null if nothing is left."""
    s = F.trim(col(c))
    parsed = F.from_json(F.when(s.startswith("[") & s.endswith("]"), s), T.ArrayType(T.StringType()))
    clean = lambda a: F.filter(F.transform(a, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    out = F.when(parsed.isNotNull(), clean(parsed)).when(s.contains(",") & ~s.startswith("http"), clean(F.split(s, ","))).otherwise(F.array(s))
    return F.when(~F.lower(s).isin(*NULL_WORDS) & (F.size(out) > 0), out)


def one_or_json(c: Column | str) -> Column:
    """The export form of references(): the text if it is one, else a JSON list."""
    return F.when(F.size(col(c)) == 1, col(c)[0]).otherwise(F.to_json(col(c)))


def explode_references(df: DataFrame, column: str, *provenance: str) -> DataFrame:
    """NJ3: a row for each reference, with its position and the provenance columns."""
    return df.select(*provenance, F.posexplode(comma_list(column)).alias("position", "reference"))


def children(df: DataFrame, array: str, *parents: str) -> DataFrame:
    """NJ4: a row for each child struct with its parent's columns; a parent without children gives one row of nulls."""
    return df.select(*parents, F.explode_outer(array).alias("_c")).select(*parents, "_c.*")


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """NJ5: every nested field as a column of its own, named by its path."""

    def walk(schema: T.StructType, path: tuple[str, ...]):
        for f in schema.fields:
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, (*path, f.name))
            else:
                yield (*path, f.name)

    return df.select(*(F.col(".".join(f"`{x}`" for x in p)).alias(separator.join(p)) for p in walk(df.schema, ())))


def typed_value(fields: Column | str, name: str) -> Column:
    """NJ12: fields.name.stringValue of a JSON text."""
    return F.get_json_object(col(fields), f"$.{name}.stringValue")


def counts_map(df: DataFrame, by: str, *keys: str) -> DataFrame:
    """NJ13: for each of keys a map from by's values to their number."""
    counted = df.where(F.col(by).isNotNull()).groupBy(*keys, by).count()
    return counted.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(by, "count")))).alias("counts"))


def without_nulls(*columns: Column | str) -> Column:
    """SF56 and NJ8: a JSON record without null fields."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "true"})


def filter_metadata(df: DataFrame, categories: list[str], ranges: list[str]) -> DataFrame:
    """NJ11: one row with the sorted values of each category and (min, median, max) of each range."""
    return df.agg(
        *(F.array_sort(F.collect_set(F.nullif(F.trim(F.col(c)), F.lit("")))).alias(c) for c in categories),
        *(F.struct(F.min(c).alias("min"), F.median(c).alias("median"), F.max(c).alias("max")).alias(c) for c in ranges),
    )


def split_wide(df: DataFrame, parts: dict[str, tuple[str, list[str]]]) -> dict[str, DataFrame]:
    """NJ14: for each part a table of its columns, rows only where its code is present; Spark reads only the columns of the part that is used."""
    return {name: df.where(F.nullif(F.trim(F.col(code).cast("string")), F.lit("")).isNotNull()).select(*columns) for name, (code, columns) in parts.items()}
