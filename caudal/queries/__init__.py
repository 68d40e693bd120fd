"""Queries over the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (t) -> DataFrame under its name; t(name) reads a table."""

    def keep(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        REGISTRY[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def cents(c: Column | str) -> Column:
    """An amount of two digits as an exact decimal, so that sums do not depend on their order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def real(c: Column, digits: int = 4) -> Column:
    return F.round(c.cast("double"), digits)


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from . import aggregation, cleaning, entities, ingest, lookups, plans, series, variants  # noqa: F401  they register themselves

    return REGISTRY, SQL
