"""Projections, filters, set operations and top-k. Each takes and returns DataFrames; nothing is collected."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Step = Callable[[DataFrame], DataFrame]


def compose(*steps: Step) -> Step:
    """UD5: right to left: the last step runs first, as in mathematics."""
    return lambda df: reduce(lambda d, f: f(d), reversed(steps), df)


def pipe(df: DataFrame, *steps: Step) -> DataFrame:
    """UD5: left to right."""
    return reduce(lambda d, f: f(d), steps, df)


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns that are computed once a row, however often later steps name them: the optimiser does not merge a generator into what follows, as it does a projection."""
    names = [f"_once_{i}" for i in range(len(columns))]
    made = df.select("*", F.inline(F.array(F.struct(*(v.alias(n) for n, v in zip(names, columns.values(), strict=True))))))
    new = dict(zip(columns, names, strict=True))
    return made.select(*(F.col(new.pop(c)).alias(c) if c in new else F.col(f"`{c}`") for c in df.columns), *(F.col(n).alias(c) for c, n in new.items()))


def rename_present(mapping: dict[str, str]) -> Step:
    """PF1: only columns that are there and whose new name is free."""
    return lambda df: reduce(lambda d, kv: d.withColumnRenamed(*kv) if kv[0] in d.columns and kv[1] not in d.columns else d, mapping.items(), df)


def with_values(rules: dict[str, Callable[[Column], Column]]) -> Step:
    """PF2: cleaners by column, for those that are there."""
    return lambda df: df.withColumns({c: f(F.col(c)) for c, f in rules.items() if c in df.columns})


def rows_where(condition: Column) -> Step:
    """PF2 and PF5: null counts as false."""
    return lambda df: df.where(condition)


def rows_unless(condition: Column) -> Step:
    """PF5: null counts as false, so such rows stay."""
    return lambda df: df.where(~F.coalesce(condition, F.lit(False)))


def drop_present(*columns: str) -> Step:
    """PF3."""
    return lambda df: df.drop(*columns)


def fixed_schema(columns: dict[str, str]) -> Step:
    """PF4: these columns in this order and type; missing ones are null, unreadable values too."""
    return lambda df: df.select(*((F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in columns.items()))


def without_words(columns: list[str], patterns: list[str]) -> Step:
    """PF6: rows of which no column holds any of the patterns, whatever the case."""
    text = lambda: F.lower(F.concat_ws("\n", *columns))
    return lambda df: df.where(~text().rlike("|".join(f"(?:{p})" for p in patterns)))


def few_nulls(most: float = 0.8) -> Step:
    """PF7: rows with at most this share of nulls."""
    return lambda df: df.where(sum((F.col(f"`{c}`").isNull().cast("int") for c in df.columns), F.lit(0)) <= most * len(df.columns))


def not_empty(df: DataFrame) -> DataFrame:
    """PF8."""
    return df.dropna("all")


def any_nonzero(columns: list[str]) -> Step:
    """PF9."""
    return lambda df: df.where(reduce(lambda a, b: a | b, (F.coalesce(F.col(c) != 0, F.lit(False)) for c in columns)))


def with_keys(*columns: str) -> Step:
    """PF10."""
    return lambda df: df.dropna("any", subset=list(columns))


def with_value(column: str) -> Step:
    """PF11."""
    return lambda df: df.where(F.col(column).isNotNull() & (F.col(column) != 0))


def not_in(column: str, *values) -> Column:
    """PF12: null is not in any list."""
    return F.coalesce(~F.col(column).isin(*values), F.lit(True))


def holds(column: str, text: str) -> Column:
    """PF13 and PF25: whatever the case; null is false."""
    return F.coalesce(F.lower(F.col(column)).contains(text.lower()), F.lit(False))


def divide(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """PF15: rows of the condition and all others, nulls among these."""
    ok = F.coalesce(condition, F.lit(False))
    return df.where(ok), df.where(~ok)


def without_last(df: DataFrame, n: int, order: str) -> DataFrame:
    """PF16: all but the last n rows by order. The n greatest keys are found by a top-k, not by a sort of all."""
    last = df.select(order).orderBy(F.col(order).desc()).limit(n)
    return df.join(F.broadcast(last), order, "left_anti")  # n rows


def geometry_types(column: str, *kinds: str) -> Step:
    """PF17."""
    return lambda df: df.where(F.col(f"{column}.type").isin(*kinds))


def assign_where(column: str, condition: Column, value) -> Step:
    """PF18 and PF24."""
    return lambda df: df.withColumn(column, F.when(condition, value).otherwise(F.col(column) if column in df.columns else F.lit(None)))


def defaults(values: dict) -> Step:
    """PF19: constants for columns that are not there."""
    return lambda df: df.withColumns({k: F.lit(v) for k, v in values.items() if k not in df.columns})


def stamped(df: DataFrame) -> DataFrame:
    """PF20."""
    return df.withColumns({"fecha_procesamiento": F.current_timestamp(), "procesado": F.lit(True)})


def nan_to_null(df: DataFrame) -> DataFrame:
    """PF21: NaN numbers and 'nan' texts."""
    out = {}
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            out[name] = F.when(~F.isnan(c), c)
        elif kind == "string":
            out[name] = F.when(~F.lower(F.trim(c)).isin("nan", "none", "nat"), c)
    return df.withColumns(out) if out else df


def require(df: DataFrame, *columns: str) -> DataFrame:
    """PF22: raises ValueError for missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def valid_features(*ids: str) -> Step:
    """PF26: features with an identifier."""
    some = lambda: F.coalesce(*(F.nullif(F.trim(F.col(f"properties.{i}").cast("string")), F.lit("")) for i in ids)).isNotNull()
    return lambda df: df.where((F.col("type") == "Feature") & some())


def union_all(*frames: DataFrame) -> DataFrame:
    """SO1: missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """SO2 and W4: for each key the row of the greatest order."""
    return _extreme(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """AG3 and JN12: for each key the row of the least order."""
    return _extreme(df, keys, order, F.min_by)


def _extreme(df: DataFrame, keys: list[str], order: str, by) -> DataFrame:
    # An aggregate, not a window: rows of a hot key are reduced before the shuffle.
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(by(F.struct(*(F.col(f"`{c}`") for c in rest)), F.col(order)).alias("_r")).select(*keys, *(F.col(f"_r.`{c}`") for c in rest)).select(*(F.col(f"`{c}`") for c in df.columns))


def missing_from(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """SO3 and JN9: rows whose key is not known; rows with a null key stay."""
    return df.join(known.select(key), key, "left_anti")


def tagged(frames: dict[str, DataFrame], column: str = "tipo_instrumento") -> DataFrame:
    """SO5."""
    return union_all(*(f.withColumn(column, F.lit(k)) for k, f in frames.items()))


def at_most(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """TK4: the first n rows by order, for a service that takes so many requests; order should end in a key."""
    return df.orderBy(*order).limit(n)


def first_value(df: DataFrame, column: str, order: str):
    """SF16: the first value by order that is not null, on the driver: what tells a programme column is that it is 4599."""
    return df.agg(F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))).first()[0]


def is_program_column(df: DataFrame, column: str, order: str) -> bool:
    """SF16."""
    v = first_value(df, column, order)
    return v is not None and str(v).removesuffix(".0") == "4599"


def logged(name: str, log: Callable[[str], None]):
    """UD6: a step that tells when it is declared and how long that took; it runs nothing."""

    def wrap(step: Step) -> Step:
        def run(df: DataFrame) -> DataFrame:
            began = time.monotonic()
            try:
                out = step(df)
            except Exception as e:
                log(f"{name}: failed after {time.monotonic() - began:.2f} s: {e}")
                raise
            log(f"{name}: {len(out.columns)} columns, {time.monotonic() - began:.2f} s")
            return out

        return run

    return wrap


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """TK1: order should end in a key, so that ties are settled."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, k: int, keys: list[str], *order: Column) -> DataFrame:
    """TK3: Spark keeps k rows of each group in each task before the shuffle (window group limit)."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO")


def severity_rank(c: Column | str) -> Column:
    """TK2: 0 is worst."""
    return F.array_position(F.array(*(F.lit(s) for s in SEVERITIES)), F.col(c) if isinstance(c, str) else c) - 1
