"""Project units: from raw records to units with their works, and the way back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import coords, dates, nested, numbers, status, text
from ..operators import aggregates as A
from ..operators import relational as R
from ..operators import windows as W
from ..operators.fuzzy import fuzzy_clusters, match_catalog
from ..operators.quality import validate_units
from ..operators.spatial import points_in_polygons, proximity_clusters, split_clusters, validation_label
from ..shared import cut

UNIT = ("nombre_up", "nombre_up_detalle", "direccion", "tipo_equipamiento", "clase_up", "comuna_corregimiento", "barrio_vereda", "nombre_centro_gestor")
WORK = ("estado", "tipo_intervencion", "fuente_financiacion", "presupuesto_base", "avance_obra", "ano", "fecha_inicio", "fecha_fin", "referencia_contrato", "referencia_proceso", "frente_activo")
#: Records that are never put together (fixed values).
ALONE_CLASSES = ("Subsidios", "Adquisición predial", "Demarcación vial")
ALONE_CENTRES = ("Secretaría de Salud Pública",)


def clean(raw: DataFrame) -> DataFrame:
    """SF17: types and texts of all columns; steps run right to left (titles last)."""
    raw = R.defaults({c: None for c in (*UNIT, *WORK, "bpin", "lat", "lon") if c not in raw.columns})(raw)
    raw = raw.select(*(F.col(c).cast("string").alias(c) if t == "void" else F.col(c) for c, t in raw.dtypes))

    def numbers_and_dates(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "presupuesto_base": numbers.money_column("presupuesto_base", as_integer=True), "avance_obra": numbers.progress("avance_obra"), "ano": numbers.budget_year("ano"),
            "fecha_inicio": dates.date_search("fecha_inicio"), "fecha_fin": dates.date_search("fecha_fin"), "referencia_contrato": nested.references("referencia_contrato"), "referencia_proceso": nested.references("referencia_proceso"),
            "bpin": numbers.bpin("bpin")["bpin"], "_c": coords.pair("lat", "lon"), "comuna_corregimiento": text.district("comuna_corregimiento"),
        }).withColumns({"lat": F.col("_c.lat"), "lon": F.col("_c.lon")}).drop("_c")

    def categories(df: DataFrame) -> DataFrame:
        return df.withColumns(status.infer_categories("nombre_up", "nombre_centro_gestor", "clase_up", "tipo_equipamiento")).withColumn("estado", status.status("estado", "avance_obra"))

    def titles(df: DataFrame) -> DataFrame:
        return df.withColumns({c: text.title_es(c) for c in ("nombre_up", "nombre_up_detalle", "direccion")})

    def fronts(df: DataFrame) -> DataFrame:
        return df.withColumn("frente_activo", status.active_front("clase_up", "tipo_equipamiento", "tipo_intervencion", "estado"))

    return R.compose(fronts, titles, categories, numbers_and_dates)(raw)


def standard_categories(df: DataFrame, catalogs: dict[str, list[str]]) -> DataFrame:
    """Values of catalogs in their standard form; values that match none stay."""
    for column, values in catalogs.items():
        df = match_catalog(df, column, values, "_std").withColumn(column, F.coalesce("_std", column)).drop("_std")
    return df


def grouped(df: DataFrame, key: str = "_row_id", metres: float = 40.0, threshold: float = 85.0, mode: str = "exact") -> DataFrame:
    """GE16 and GE17: each record with its cluster: near records of equal names, then similar texts, and records that stand alone."""
    groupable = R.not_in("clase_up", *ALONE_CLASSES) & R.not_in("nombre_centro_gestor", *ALONE_CENTRES)
    yes, no = R.divide(df, groupable)
    placed, loose = R.divide(yes, F.col("lat").isNotNull() & F.col("lon").isNotNull())
    geo = split_clusters(proximity_clusters(placed, key, "lat", "lon", metres), key, "nombre_up", "nombre_up_detalle")
    geo = geo.withColumn("cluster", F.format_string("GEO-%d-%d", F.col("cluster_geo"), F.coalesce("part", F.lit(0)).cast("bigint"))).drop("cluster_geo", "part")
    fuzzy = fuzzy_clusters(loose, key, "nombre_up", "nombre_up_detalle", "direccion", threshold, mode)
    fuzzy = fuzzy.withColumn("cluster", F.concat(F.lit("FUZZY-"), F.col("cluster_fuzzy").cast("string"))).drop("cluster_fuzzy")
    alone = no.withColumn("cluster", F.concat(F.lit("ISOLATED-"), F.col(key).cast("string")))
    return R.union_all(geo, fuzzy, alone)


def with_upids(df: DataFrame, cluster: str = "cluster", start: int = 0) -> DataFrame:
    """W6, W8 and TK6: UNP-n by the clusters' order as texts, and the works' numbers in each unit."""
    ids = W.global_ids(df.select(cluster).distinct(), [cluster], "_n", start)
    out = df.join(ids.select(cluster, F.concat(F.lit("UNP-"), F.col("_n").cast("string")).alias("upid")), cluster)
    out = W.sequence(out, ["upid"], ["_row_id"], "_i")
    return out.withColumn("intervencion_id", F.format_string("%s-%02d", F.col("upid"), F.col("_i"))).drop("_i")


def to_units(df: DataFrame) -> DataFrame:
    """AG24, AG25 and AG26: a row for each unit with its fullest fields, its place, sums, and the array of its works."""
    summary = {c: A.fullest(c, "_row_id") for c in UNIT}
    summary |= {"_p": A.consolidated_point("lat", "lon", "_row_id", coords.BOX_EXPORT), "presupuesto_base": A.sum0("presupuesto_base"), "avance_obra": F.bround(A.weighted_mean("avance_obra", "presupuesto_base"), 2)}
    units = A.nested(df, ["upid"], ["intervencion_id", *WORK], "intervenciones", "_row_id", **summary)
    units = units.withColumnRenamed("n", "n_intervenciones").withColumns({"lat": F.col("_p.lat"), "lon": F.col("_p.lon")}).drop("_p")
    return units.withColumn("geometry", coords.point("lat", "lon"))


def to_rows(units: DataFrame) -> DataFrame:
    """NJ4: the works of all units, a row each, with the unit's fields."""
    return nested.children(units.withColumnsRenamed({"presupuesto_base": "presupuesto_unidad", "avance_obra": "avance_unidad"}), "intervenciones", "upid", *UNIT, "lat", "lon")


def located(df: DataFrame, districts: DataFrame, quarters: DataFrame, key: str = "_row_id") -> DataFrame:
    """JN10 and GE19: the polygons that points are in, and whether they agree with what the record says."""
    out = points_in_polygons(df, districts.withColumnRenamed("name", "district"), "lon", "lat", key, "district")
    out = points_in_polygons(out, quarters.withColumnRenamed("name", "quarter"), "lon", "lat", key, "quarter")
    return out.withColumn("validacion", validation_label(F.col("in_district"), F.col("comuna_corregimiento"), F.col("in_quarter"), F.col("barrio_vereda")))


def run(raw: DataFrame, equipment: list[str], mode: str = "exact") -> tuple[DataFrame, DataFrame]:
    """QD12: raw records (with _row_id) to units and their quality issues.

    Cleaned records and their clusters are written, as grouping and numbering each read them several times.
    """
    units = to_units(with_upids(cut(grouped(cut(clean(raw), "clean"), mode=mode), "grouped")))
    return units, validate_units(units, equipment)


def extract(spark, folder: str, keep: str | None = None, rename: dict[str, str] | None = None) -> DataFrame:
    """SRC29: the records of a folder's files, in memory or also written as Parquet to `keep`; numbered, with columns renamed where they are present."""
    from ..sources.files import scan_folder

    rows = R.rename_present(rename or {})(scan_folder(spark, folder))
    rows = W.global_ids(rows, ["_archivo_origen", *(c for c in rows.columns if not c.startswith("_"))], "_row_id")
    if keep:
        rows.write.mode("overwrite").parquet(keep)
        return spark.read.parquet(keep)
    return rows
