"""Writers. All are distributed; names of files are Spark's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coords import BOX_POINT, point
from ..functions.text import printable
from ..operators.cdc import changelog
from .keyed import current_version, read_current, write_upsert  # noqa: F401  part of this module's interface


def features(df: DataFrame, lat: str = "lat", lon: str = "lon", box=BOX_POINT) -> DataFrame:
    """SNK1 and SNK2: one GeoJSON feature as text for each row; a missing geometry is built from lat and lon within the box (None: anywhere)."""
    has = "geometry" in df.columns
    made = point(lat, lon, box) if lat in df.columns and lon in df.columns else F.lit(None).cast("struct<type:string,coordinates:array<double>>")
    geometry = F.coalesce(F.to_json("geometry"), F.to_json(made)) if has else F.to_json(made)
    rest = [c for c in df.columns if c != "geometry"]
    body = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*(F.col(f"`{c}`") for c in rest)), {"ignoreNullFields": "false"}), F.lit(',"geometry":'), F.coalesce(geometry, F.lit("null")), F.lit("}"))
    return df.select(body.alias("value"))


def write_geojson(df: DataFrame, path: str, kinds: list[str] | None = None, box=BOX_POINT) -> None:
    """SNK1 and SNK2: features, one a line (GeoJSON text sequence), so that the file can be split; only geometries of `kinds` if given; box as in features()."""
    if kinds:
        df = df.where(F.col("geometry.type").isin(*kinds))
    features(df, box=box).write.mode("overwrite").text(path)


def as_one_file(spark, folder: str, target: str) -> None:
    """The one part file of a written folder under a name of its own, for readers outside Spark; raises if there are several."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    parts = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise ValueError(f"{len(parts)} part files in {folder}")
    fs.rename(parts[0], jvm.org.apache.hadoop.fs.Path(target))
    fs.delete(root, True)


def write_json(df: DataFrame, path: str, compress: bool = False) -> None:
    """SNK3, SNK4, SNK12 and SNK17."""
    df.write.mode("overwrite").option("compression", "gzip" if compress else "none").json(path)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """SNK5: one CSV folder for each sheet of a workbook."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def write_by_key(df: DataFrame, path: str, key: str, *drop: str) -> None:
    """SNK14 and SNK19: one folder for each value of key, without some columns."""
    df.drop(*drop).write.mode("overwrite").partitionBy(key).option("header", True).csv(path)


def replace_all(df: DataFrame, path: str) -> None:
    """SNK9 and SNK18."""
    df.write.mode("overwrite").parquet(path)


def write_changes(old: DataFrame, new: DataFrame, path: str, key: str, columns: list[str], at: Column | None = None) -> None:
    """SNK11: changelog entries appended."""
    changelog(old, new, key, columns).withColumn("changed_at", F.current_timestamp() if at is None else at).write.mode("append").parquet(path)


def write_latest_and_archive(df: DataFrame, path: str, stamp: str) -> None:
    """SNK12: gzip JSON as `latest`, and under its time stamp."""
    df.write.mode("overwrite").option("compression", "gzip").json(f"{path}/archive/{stamp}")
    df.sparkSession.read.json(f"{path}/archive/{stamp}").write.mode("overwrite").option("compression", "gzip").json(f"{path}/latest")


def write_critical(found: DataFrame, path: str) -> None:
    """SNK13."""
    found.where(F.col("severity") == "CRITICAL").write.mode("overwrite").option("header", True).csv(path)


def log_run(spark, path: str, name: str, rows: int, ok: bool, started: str, ended: str, message: str = "") -> None:
    """SNK22: one row appended to the log table."""
    spark.createDataFrame([(name, rows, ok, started, ended, message)], "pipeline string, rows long, ok boolean, started string, ended string, message string").coalesce(1).write.mode("append").json(path)


def short_names(columns: list[str], most: int = 10) -> dict[str, str]:
    """SNK15: unique names of at most so many characters, as shape files ask for."""
    out: dict[str, str] = {}
    taken: set[str] = set()
    for c in columns:
        n, i = c[:most], 1
        while n.lower() in taken:
            n = f"{c[: most - len(str(i)) - 1]}_{i}"
            i += 1
        taken.add(n.lower())
        out[c] = n
    return out


def kml_placemarks(df: DataFrame, name: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """SNK15: one KML placemark as text for each row with a place."""
    esc = F.replace(F.replace(F.replace(F.col(name), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.format_string("<Placemark><name>%s</name><Point><coordinates>%s,%s</coordinates></Point></Placemark>", F.coalesce(esc, F.lit("")), F.col(lon).cast("string"), F.col(lat).cast("string")).alias("value"))


def safe_texts(df: DataFrame) -> DataFrame:
    """SNK20: texts without control characters."""
    texts = {c: printable(F.col(f"`{c}`")) for c, t in df.dtypes if t == "string"}
    return df.withColumns(texts) if texts else df
