"""The index of contracting processes: codes, lookups and lists, by DataFrame steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nested import comma_list
from ..operators.quality import checks
from ..operators.relational import once


def whole(c: Column) -> Column:
    """A number's whole part as text; anything else as it is."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^-?\d+(\.\d+)?$"), text.cast("decimal(38,10)").cast("decimal(38,0)").cast("string")).otherwise(c.cast("string"))


def centre_of_project(projects: DataFrame) -> DataFrame:
    """bpin (text) and the first row's centre of it."""
    known = projects.where(F.col("bpin").isNotNull() & F.col("nombre_centro_gestor").isNotNull())
    return known.groupBy(F.col("bpin").cast("string").alias("bpin")).agg(F.min_by("nombre_centro_gestor", "_row_id").alias("nombre_centro_gestor"))


def project_of_code(projects: DataFrame) -> DataFrame:
    """The number of a code BP<number> and the last row's bpin of it."""
    known = projects.where(F.col("bp").startswith("BP") & F.col("bpin").isNotNull() & (F.col("bpin").cast("string") != ""))
    return known.groupBy(F.expr("substring(bp, 3)").alias("bp")).agg(F.max_by(F.col("bpin").cast("string"), "_row_id").alias("_bpin"))


def transform(index: DataFrame, projects: DataFrame) -> DataFrame:
    """SRC25: the index sheet (bp, bpin, id_paa, referencia_proceso, referencia_contrato) with coded bp, bpin by its own value or that of its bp, the project's centre, and references as lists.

    projects: bpin, bp, nombre_centro_gestor, _row_id. Numbers are texts without decimals; what is no number stays as it is.
    """
    out = index.drop("nombre_centro_gestor").withColumn("bp", F.col("bp").cast("string")).join(project_of_code(projects), "bp", "left")
    own = F.when(~F.coalesce(F.trim(F.col("bpin").cast("string")), F.lit("")).isin("", "0"), F.col("bpin").cast("string"))
    out = once(out, {"bpin": whole(F.coalesce(own, "_bpin")), "id_paa": whole(F.col("id_paa")), "referencia_proceso": comma_list("referencia_proceso"), "referencia_contrato": comma_list("referencia_contrato"), "bp": F.concat(F.lit("BP"), F.col("bp"))})
    return out.drop("_bpin").join(centre_of_project(projects), "bpin", "left")


def figures(index: DataFrame, made: DataFrame) -> DataFrame:
    """SRC25: one row: how many rows each step reached."""
    some = lambda c: F.count_if(F.col(c).isNotNull())
    before = index.agg(F.count_if(F.coalesce(F.trim(F.col("bpin").cast("string")), F.lit("")).isin("", "0")).alias("_without"))
    out = made.agg(F.count("*").alias("total"), some("bp").alias("coded"), some("bpin").alias("with_bpin"), some("nombre_centro_gestor").alias("with_centre"), F.count_if(F.size("referencia_proceso") > 1).alias("several_processes"), F.count_if(F.size("referencia_contrato") > 1).alias("several_contracts"), F.count_if(F.col("bpin").isNull()).alias("_still"))
    return out.crossJoin(F.broadcast(before)).withColumn("bpin_by_code", F.col("_without") - F.col("_still")).drop("_without", "_still")  # one row each


def valid(made: DataFrame) -> DataFrame:
    """SRC25: one row of checks, over all rows."""
    number = lambda c: F.col(c).isNull() | F.col(c).rlike(r"^-?\d+$")
    return checks(made, {"codes": F.col("bp").isNull() | F.col("bp").startswith("BP"), "bpin_whole": number("bpin"), "id_paa_whole": number("id_paa"), "lists": F.col("referencia_proceso").isNotNull() & F.col("referencia_contrato").isNotNull()})
