"""Contracts, processes and payments: cleaning, indexes by project, and the gap report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, numbers, status, text
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import relational as R


def clean_contracts(raw: DataFrame) -> DataFrame:
    """PF5, SF5, SF29, SF30 and SF39: without personal services and without undefined projects."""
    df = R.rows_unless((F.lower("tipo_contrato") == "prestación de servicios") | (F.col("bpin") == "No Definido"))(raw)
    return df.withColumns({
        "referencia_contrato": text.contract_reference("referencia_contrato"), "valor_contrato": numbers.peso_integer("valor_contrato"),
        "fecha_firma": dates.date_iso("fecha_firma"), "bpin": numbers.digits_only("bpin"),
    })


def by_project(contracts: DataFrame, order: str = "_row_id") -> DataFrame:
    """AG21: for each project counts, sums, banks, dates and the array of contracts."""
    return A.nested(
        contracts, ["bpin"], ["referencia_contrato", "valor_contrato", "estado_contrato", "fecha_firma"], "contratos", order,
        total=A.sum0("valor_contrato"), mean=F.avg("valor_contrato"), states=F.array_sort(F.collect_set("estado_contrato")), first=F.min("fecha_firma"), last=F.max("fecha_firma"),
    )


def index(contracts: DataFrame, order: str = "_row_id") -> DataFrame:
    """AG22."""
    return A.nested(contracts, ["bpin"], ["referencia_contrato", "valor_contrato", "estado_contrato", "proceso_compra"], "contratos", order).drop("n")


def processes_by_project(processes: DataFrame, contracts: DataFrame, order: str = "_row_id") -> DataFrame:
    """AG23 and JN6: processes with the project of their contracts."""
    link = contracts.where(F.col("proceso_compra").isNotNull()).groupBy("proceso_compra").agg(F.min_by("bpin", order).alias("bpin"))
    return A.nested(J.attach(processes, link, "proceso_compra"), ["bpin"], ["proceso_compra", "referencia_proceso", "estado"], "procesos", order)


def gap_report(contracts: DataFrame, reports: DataFrame, key: str = "referencia_contrato") -> DataFrame:
    """W4, SF48, AG31 and AG32: each contract's latest report and what is behind."""
    latest = R.keep_last(reports, [key], "fecha_reporte")
    df = J.match_as_text(latest, contracts, key, key)
    return df.withColumns(status.gap("avance_fisico", "avance_financiero", "valor_contrato", "alertas_es_alerta"))


def risk_by(df: DataFrame, key: str) -> DataFrame:
    """AG31 and AG32."""
    return df.groupBy(key).agg(F.count("*").alias("n"), A.sum_if(F.col("critical"), "pending").alias("at_risk"), A.sum0("pending").alias("pending"), F.avg("delta").alias("mean_delta"))
