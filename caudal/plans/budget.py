"""Budget execution: scans of yearly files to a dimension and two fact tables; monitoring plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, nested, numbers, text
from ..operators import aggregates as A
from ..operators import relational as R

MOVEMENTS = ("ppto_inicial", "reducciones", "adiciones", "contracreditos", "creditos", "aplazamiento", "desaplazamiento", "ppto_modificado")
EXECUTION = ("total_acumulado_cdp", "total_acumulado_rpc", "total_acumul_obligac", "pagos", "ejecucion", "saldos_cdp", "ppto_disponible")
DIMENSION = ("bp", "nombre_proyecto", "nombre_actividad", "programa_presupuestal", "cod_centro_gestor", "nombre_centro_gestor", "cod_area_funcional", "fondo", "cod_fondo", "comuna", "origen", "tipo_gasto", "cod_sector", "cod_producto")
PROVENANCE = ("dataframe_origen", "archivo_origen")


def prepared(raw: DataFrame) -> DataFrame:
    """Typed rows: few nulls, amounts as whole pesos, codes, and the period's last day. raw has _row_id, dataframe_origen and anio."""
    df = R.few_nulls(0.8)(raw)
    money = {c: numbers.whole_number(F.col(c).cast("string")) for c in (*MOVEMENTS, *EXECUTION) if c in df.columns}
    df = R.once(df, money | {"bpin": numbers.digits_only(F.col("bpin").cast("string")), "periodo_corte": dates.period_end("dataframe_origen", "anio")})
    return df.withColumn("bp", text.budget_code("bp")) if "bp" in df.columns else df


def _facts(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    own = [c for c in names if c in df.columns]
    rows = R.pipe(df, R.with_keys("bpin", "periodo_corte"), R.any_nonzero(own))
    return A.facts_by_period(rows, ["bpin", "periodo_corte"], own, [c for c in PROVENANCE if c in df.columns], "_row_id")


def movements(df: DataFrame) -> DataFrame:
    """AG1."""
    return _facts(df, MOVEMENTS)


def execution(df: DataFrame) -> DataFrame:
    """AG2."""
    return _facts(df, EXECUTION)


def dimension(df: DataFrame) -> DataFrame:
    """AG3: the first row of each project."""
    return R.keep_first(R.with_keys("bpin")(df).select("bpin", *(c for c in DIMENSION if c in df.columns), "_row_id"), ["bpin"], "_row_id").drop("_row_id")


def monitoring(df: DataFrame) -> dict[str, DataFrame]:
    """NJ14 and SO2: activities, products and a summary out of wide rows; of one key and period the last row counts."""
    parts = nested.split_wide(df, {
        "activities": ("cod_actividad", ["bpin", "cod_actividad", "nombre_actividad", "avance_actividad", "periodo_corte", "_row_id"]),
        "products": ("cod_producto", ["bpin", "cod_producto", "nombre_producto", "avance_producto", "periodo_corte", "_row_id"]),
        "summary": ("bpin", ["bpin", "avance_proyecto", "periodo_corte", "_row_id"]),
    })
    keys = {"activities": ["bpin", "cod_actividad", "periodo_corte"], "products": ["bpin", "cod_producto", "periodo_corte"], "summary": ["bpin", "periodo_corte"]}
    return {k: R.keep_last(v, keys[k], "_row_id").drop("_row_id") for k, v in parts.items()}
