"""Directory scans, GeoJSON, headers and provenance."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import header_budget
from ..operators.relational import union_all

READERS: dict[str, Callable[[SparkSession, list[str], str], DataFrame]] = {
    "csv": lambda s, p, enc: s.read.options(header=True, encoding=enc, mode="PERMISSIVE", multiLine=True, escape='"').csv(p),
    "tsv": lambda s, p, enc: s.read.options(header=True, encoding=enc, mode="PERMISSIVE", sep="\t").csv(p),
    "txt": lambda s, p, enc: s.read.options(header=True, encoding=enc, mode="PERMISSIVE", sep="|").csv(p),
    "json": lambda s, p, enc: s.read.options(multiLine=True, encoding=enc, mode="PERMISSIVE").json(p),
    "parquet": lambda s, p, enc: s.read.option("mergeSchema", True).parquet(*p),
}
#: Of text files. Spark has no reader for windows-1252: it is read as ISO-8859-1, and its own letters are put right.
ENCODINGS = ("UTF-8", "windows-1252", "ISO-8859-1")
_C1 = {chr(b): bytes([b]).decode("cp1252", "replace") for b in range(0x80, 0xA0)}


def list_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of a folder's files, by Hadoop's file system, so any store that Spark reads will do."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted((f.getPath().toString(), f.getLen()) for f in fs.listStatus(path) if f.isFile() or f.getPath().getName().endswith(".parquet"))


def encodings_of(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The encoding of each file, by one scan over all: UTF-8 unless a line is not valid in it; then windows-1252 if there are bytes that ISO-8859-1 has no letters for."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    bad = lines.where(~F.is_valid_utf8("value"))
    found = bad.groupBy("path").agg(F.max(F.hex(F.col("value").cast("binary")).rlike("^(..)*[89]")).alias("c1")).collect()  # a row for each such file
    by_name = {r.path.split(":", 1)[-1].lstrip("/"): ENCODINGS[1] if r.c1 else ENCODINGS[2] for r in found}
    return {p: by_name.get(_plain(spark, p), ENCODINGS[0]) for p in paths}


def _plain(spark: SparkSession, path: str) -> str:
    """The path as Spark's file metadata has it, without its scheme."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().toString().split(":", 1)[-1].lstrip("/")


def first_line(spark: SparkSession, path: str, encoding: str, most: int = 1 << 16) -> str:
    """A text file's first line, of its first bytes alone."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        raw = bytes(stream.readNBytes(most))
    finally:
        stream.close()
    return raw.decode(encoding, "replace").lstrip("\ufeff").split("\n", 1)[0].rstrip("\r")


def with_source(df: DataFrame) -> DataFrame:
    """SRC6: where rows come from: file, month and year by its name."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    name = F.url_decode(name)
    return df.select("*", name.alias("_archivo_origen"), dates.file_month(name).alias("_mes_asociado"), dates.file_year(name).alias("_vigencia_asociada"))


def scan_folder(spark: SparkSession, folder: str, *, normalise: Callable[[str], str] = header_budget, errors: list[tuple[str, str]] | None = None) -> DataFrame:
    """SRC1, SRC2, SRC3 and SRC6: all readable files of a folder by their extension, as one table of texts with provenance.

    Files of one extension, encoding and (of delimited texts) header are one scan; of each workbook the sheet that looks most like a table is read. A file that cannot be read is noted in `errors` and left out, without `errors` it raises; one of a kind that has no reader is noted, or else warned of. Marks of file systems (names that begin with . or _) are no files.
    """
    from .archives import read_sheet

    by_kind: dict[str, list[str]] = {}
    frames = []

    def failed(paths: list[str], why: str) -> None:
        if errors is None:
            raise ValueError(f"{paths[0]}: {why}")
        errors.extend((p, why) for p in paths)

    for path, _ in list_files(spark, folder):
        name = path.rsplit("/", 1)[-1]
        kind = name.rsplit(".", 1)[-1].lower()
        if name.startswith((".", "_")):
            continue
        if kind in READERS:
            by_kind.setdefault(kind, []).append(path)
        elif kind == "xlsx":
            try:
                book = read_sheet(spark, path, normalise=normalise)
                name = F.col("_archivo_origen")
                frames.append(book.drop("_fila").withColumns({"_archivo_origen": F.url_decode(name), "_mes_asociado": dates.file_month(F.url_decode(name)), "_vigencia_asociada": dates.file_year(F.url_decode(name))}).select(*(F.col(f"`{c}`").cast("string") for c in (*(c for c in book.columns if c not in ("_fila", "_archivo_origen")), "_archivo_origen", "_mes_asociado", "_vigencia_asociada"))))
            except Exception as e:  # one bad workbook does not stop the scan; the caller sees which
                failed([path], str(e).splitlines()[0])
        elif errors is None:
            warnings.warn(f"{path}: no reader for this kind of file", stacklevel=2)
        else:
            failed([path], "no reader for this kind of file")
    for kind, paths in sorted(by_kind.items()):
        encodings = encodings_of(spark, paths) if kind != "parquet" else dict.fromkeys(paths, ENCODINGS[0])
        alike: dict[tuple[str, str], list[str]] = {}
        for path in paths:
            header = first_line(spark, path, encodings[path]) if kind in ("csv", "tsv", "txt") else ""
            alike.setdefault((encodings[path], header), []).append(path)
        for (encoding, _), group in sorted(alike.items()):
            try:
                windows = encoding == ENCODINGS[1]
                df = with_source(READERS[kind](spark, group, ENCODINGS[2] if windows else encoding))
                read = lambda c: F.translate(F.col(f"`{c}`").cast("string"), "".join(_C1), "".join(_C1.values())) if windows else F.col(f"`{c}`").cast("string")  # noqa: B023, E731
                frames.append(df.select(*(F.col(f"`{c}`").cast("string").alias(c) if c.startswith("_") else read(c).alias(normalise(c.lstrip("\ufeff").translate(str.maketrans(_C1)) if windows else c.lstrip("\ufeff"))) for c in df.columns)))
            except Exception as e:  # one bad group of files does not stop the scan; the caller sees which
                if errors is None:
                    raise
                failed(group, str(e).splitlines()[0])
    if not frames:
        raise FileNotFoundError(f"nothing readable in {folder}")
    return union_all(*frames)


def with_period(df: DataFrame) -> DataFrame:
    """SRC4: the period (yyyy-MM) that the file name tells."""
    return df.withColumn("periodo_corte", dates.file_period(F.col("_archivo_origen")))


def since_year(df: DataFrame, year: int) -> DataFrame:
    """PF23: rows of files of that year or later."""
    return df.where(F.col("_vigencia_asociada").cast("int") >= year)


HEADER_WORDS = ("bpin", "proyecto", "organismo", "centro", "presupuesto", "valor", "contrato", "fecha", "nombre")


def header_score(cells: list[str | None]) -> float:
    """SRC5: how much a row looks like a header: filled cells, texts rather than numbers, known words, no repeats."""
    filled = [str(c).strip().lower() for c in cells if c is not None and str(c).strip()]
    if not filled:
        return 0.0
    texts = [c for c in filled if not re.fullmatch(r"[\d.,%$ \-]+", c)]
    known = sum(any(w in c for w in HEADER_WORDS) for c in filled)
    return len(filled) / len(cells) + len(texts) / len(filled) + 2.0 * known / len(filled) - (len(filled) - len(set(filled))) / len(filled)


def best_header(rows: list[list[str | None]], candidates: int = 15) -> int:
    """SRC5: the row that looks most like a header among the first ones."""
    return max(range(min(candidates, len(rows))), key=lambda i: (header_score(rows[i]), -i))


def read_with_header_search(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """SRC5: a text table whose header is somewhere in its first lines. Only those lines reach the driver; rows above the header are told by their number."""
    raw = spark.read.options(header=False, sep=sep, encoding=encoding).csv(path)
    top = [list(r) for r in raw.limit(15).collect()]
    at = best_header(top)
    names = [header_budget(str(v)) if v else f"column_{i}" for i, v in enumerate(top[at])]
    head = {tuple(r) for r in top[: at + 1]}
    same = reduce(lambda a, b: a | b, (reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(raw.columns, h, strict=True))) for h in head))
    return raw.where(~same).toDF(*names)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """SRC13: one row for each feature: type, properties, geometry. Gzip is told by the extension (SRC17)."""
    return spark.read.option("multiLine", True).json(path).select(F.explode("features").alias("f")).select("f.*")


def flat_features(features: DataFrame) -> DataFrame:
    """SRC14."""
    return features.select("properties.*", "geometry")


def find_text(df: DataFrame, text: str, limit: int | None = None) -> DataFrame:
    """SRC28: rows of which any cell holds the text, whatever the case; `limit` for a look at some."""
    hit = F.exists(F.array(*(F.lower(F.col(f"`{c}`").cast("string")) for c in df.columns)), lambda x: x.contains(text.lower()))
    out = df.where(F.coalesce(hit, F.lit(False)))
    return out.limit(limit) if limit else out


def coordinate_columns(columns: list[str]) -> tuple[str | None, str | None]:
    """SRC22: which columns are latitude and longitude, by name."""
    pick = lambda *words: next((c for c in columns if any(w in c.lower() for w in words)), None)
    return pick("lat", "coord_y", "norte"), pick("lon", "lng", "coord_x", "este")


def points_table(df: DataFrame) -> DataFrame:
    """SRC22: the table with lat and lon as numbers, where its columns tell them."""
    from ..functions.coords import decimal

    lat, lon = coordinate_columns(df.columns)
    if not lat or not lon:
        raise ValueError("no coordinate columns")
    return df.withColumns({"lat": decimal(F.col(lat).cast("string")), "lon": decimal(F.col(lon).cast("string"))})


ORGANISATION_WORDS = ("secretaria", "secretaría", "departamento", "direccion", "dirección", "unidad", "oficina", "agencia", "instituto")


def organisation_column(df: DataFrame, sample: int = 300) -> str | None:
    """SRC24: the column that names organisations: by header, and by how many of the first values look like names of such; one row of counts reaches the driver."""
    texts = [c for c, t in df.dtypes if t == "string"]
    if not texts:
        return None
    looks = lambda c: F.avg(F.lower(F.col(c)).rlike("|".join(ORGANISATION_WORDS)).cast("double"))
    row = df.select(*texts).limit(sample).agg(*(looks(c).alias(c) for c in texts)).first()
    name = lambda c: 2.0 * any(w in c.lower() for w in ("organismo", "centro_gestor", "centro gestor")) + 1.0 * ("nombre" in c.lower())
    best = max(texts, key=lambda c: (name(c) + 2.0 * (row[c] or 0.0), c))
    return best if name(best) + 2.0 * (row[best] or 0.0) >= 1.0 else None


def unique_values(df: DataFrame) -> DataFrame:
    """SRC21: one row: for each column its sorted different values."""
    return df.agg(*(F.array_sort(F.collect_set(F.col(f"`{c}`").cast("string"))).alias(c) for c in df.columns))


def latest_row(df: DataFrame, order: str) -> DataFrame:
    """SRC30."""
    return df.orderBy(F.col(order).desc()).limit(1)


def typed_amounts(df: DataFrame, money: list[str]) -> DataFrame:
    """SRC27: texts trimmed, amounts as whole numbers."""
    from ..functions.numbers import whole_number

    kinds = dict(df.dtypes)
    cols: dict[str, Column] = {c: whole_number(F.col(c).cast("string")) for c in money}
    cols |= {c: F.trim(c) for c in df.columns if c not in money and kinds[c] == "string"}
    return df.withColumns(cols)


def valid_references(df: DataFrame, column: str) -> DataFrame:
    """SRC26: rows with a reference that is not blank."""
    return df.where(F.nullif(F.trim(F.col(column)), F.lit("")).isNotNull())


def load_collections(spark: SparkSession, root: str, schemas: dict[str, str], errors: list[tuple[str, str]] | None = None) -> dict[str, DataFrame]:
    """SRC20: the named collections of a folder as tables: JSON or Parquet under the collection's name; one that is missing or cannot be read is empty, with its schema, and noted in `errors`."""
    out = {}
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name, schema in schemas.items():
        found = None
        for kind in ("parquet", "json"):
            for path in (f"{root}/{name}.{kind}", f"{root}/{name}"):
                where = jvm.org.apache.hadoop.fs.Path(path)
                fs = where.getFileSystem(conf)
                if found is None and fs.exists(where) and (path.endswith(kind) or any(f.getPath().getName().endswith((f".{kind}", f".{kind}.gz")) for f in fs.listStatus(where))):
                    found = spark.read.schema(schema).format(kind).load(path)
        if found is None and errors is not None:
            errors.append((name, "no such collection"))
        out[name] = spark.createDataFrame([], schema) if found is None else found
    return out
