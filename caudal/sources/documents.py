"""Files of other programs as data sources: workbooks, GeoJSON collections, shape files.

Tasks write files, under names of their own, through pyarrow's file systems; when
all tasks are done the driver gives the files of the runs that count their names,
and a failed job's files go. No row reaches the driver.

A workbook is made by one task, as a zip file has one writer; what the format
cannot hold (MOST_ROWS a sheet) goes on in a further workbook, so no task gets more. A
GeoJSON collection is one file by its nature: its parts are made by tasks and
joined as streams. A shape file set is written for each task, and read by ranges of records.
"""

from __future__ import annotations

import json
import math
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..functions.coords import BOX_POINT
from ..operators.windows import global_ids
from ..shared import cut
from .sinks import features, short_names

#: Rows of a sheet under its header (the format's own bound is 1,048,576 with it).
MOST_ROWS = 1_000_000


def place(path: str):
    """A pyarrow file system and the path in it; a path without a scheme is a local or mounted one."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"\w+:", path) else (fs.LocalFileSystem(), path)


class Made(WriterCommitMessage):
    """What one task wrote: (name while it is not committed, name to be) pairs, in order of the task's number."""

    def __init__(self, task: int, files: list[tuple[str, str]]) -> None:
        self.task, self.files = task, files


class FilesWriter(DataSourceArrowWriter):
    """Writes under names that only its run knows; commit() names the files."""

    def __init__(self, options: dict, schema: T.StructType) -> None:
        self.options, self.schema, self.path = options, schema, options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        self.fs, self.base = place(self.path)
        self.fs.create_dir(self.base, recursive=True)
        return Made(TaskContext.get().partitionId(), self.made(iterator))

    def hidden(self) -> str:
        return f"{self.base}/.{uuid.uuid4().hex}.part"

    def made(self, batches: Iterator[pa.RecordBatch]) -> list[tuple[str, str]]:
        raise NotImplementedError

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, base = place(self.path)
        fs.create_dir(base, recursive=True)
        self.named(fs, base, [f for m in sorted((m for m in messages if m), key=lambda m: m.task) for f in m.files])

    def named(self, fs, base: str, files: list[tuple[str, str]]) -> None:
        for hidden, name in files:
            fs.move(hidden, f"{base}/{name}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, _ = place(self.path)
        for hidden, _ in (f for m in messages if m for f in m.files):
            fs.delete_file(hidden)


def _written(df: DataFrame, source: type[DataSource], path: str, **options) -> None:
    df.sparkSession.dataSource.register(source)
    df.write.format(source.name()).options(path=path, **options).mode("append").save()


# --- workbooks -----------------------------------------------------------------

_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_NO_XML = re.compile("[^\\t\\n\\r\\x20-\\ud7ff\\ue000-\\ufffd\\U00010000-\\U0010ffff]")


def column_name(i: int) -> str:
    """0 is A, 26 is AA."""
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


class Workbook:
    """One workbook written as a stream, sheet after sheet."""

    def __init__(self, sink) -> None:
        self.sink, self.zip, self.sheets, self.open, self.row = sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED), [], None, 0

    def sheet(self, name: str, header: list[str]) -> None:
        self._end_sheet()
        name = re.sub(r"[\[\]:*?/\\]", "_", name)[:31] or "sheet"
        base, n = name, 1
        while name.lower() in {s.lower() for s in self.sheets}:
            n += 1
            name = f"{base[: 30 - len(str(n))]}_{n}"
        self.sheets.append(name)
        self.open, self.row = self.zip.open(f"xl/worksheets/sheet{len(self.sheets)}.xml", "w", force_zip64=True), 0
        self.open.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
        self.add(header, "s" * len(header))

    def add(self, cells: list[str | None], kinds: str) -> None:
        self.row += 1
        out = []
        for i, (v, k) in enumerate(zip(cells, kinds, strict=True)):
            if v is not None:
                ref = f"{column_name(i)}{self.row}"
                out.append(f'<c r="{ref}"><v>{v}</v></c>' if k == "n" and math.isfinite(float(v)) else f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(_NO_XML.sub("", v))}</t></is></c>')
        self.open.write(f'<row r="{self.row}">{"".join(out)}</row>'.encode())

    def _end_sheet(self) -> None:
        if self.open:
            self.open.write(b"</sheetData></worksheet>")
            self.open.close()

    def close(self) -> None:
        self._end_sheet()
        n = range(1, len(self.sheets) + 1)
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in n)
        self.zip.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>')
        self.zip.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        sheets = "".join(f'<sheet name="{escape(s, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, s in zip(n, self.sheets, strict=True))
        self.zip.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets>{sheets}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{_LINKS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n)
        self.zip.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>')
        self.zip.close()
        self.sink.close()


class WorkbookWriter(FilesWriter):
    """Rows in order of book and sheet: book, sheet, header, kinds, cells (null in a row that only names its sheet)."""

    def made(self, batches):
        out, now, book, sheet = [], None, None, None
        for b in batches:
            for name, page, header, kinds, cells in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("book", "sheet", "header", "kinds", "cells")), strict=True):
                if name != now:
                    if book:
                        book.close()
                    out.append((self.hidden(), f"{name}.xlsx"))
                    book, now, sheet = Workbook(self.fs.open_output_stream(out[-1][0])), name, None
                if page != sheet:
                    book.sheet(page, header)
                    sheet = page
                if cells is not None:
                    book.add(cells, kinds)
        if book:
            book.close()
        return out


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbooks"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WorkbookWriter(dict(self.options), schema)


_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _cells(df: DataFrame, columns: list[str], *first) -> DataFrame:
    kinds = "".join("n" if dict(df.dtypes)[c] in _NUMBERS or dict(df.dtypes)[c].startswith("decimal") else "s" for c in columns)
    text = lambda c: F.col(f"`{c}`") if not dict(df.dtypes)[c].startswith(("array", "map", "struct")) else F.to_json(f"`{c}`")
    return df.select(*first, F.array(*(F.lit(c) for c in columns)).alias("header"), F.lit(kinds).alias("kinds"), F.array(*(text(c).cast("string") for c in columns)).alias("cells"))


def _file_name(c):
    return F.when(F.coalesce(F.trim(c.cast("string")), F.lit("")) == "", "sin valor").otherwise(F.substring(F.regexp_replace(c.cast("string"), r'[\\/:*?"<>|\x00-\x1f.]', "_"), 1, 100))


def _save(rows: DataFrame, path: str, most: int) -> None:
    """rows: book, page (number), sheet, key (order), header, kinds, cells."""
    numbered = cut(global_ids(rows, ["book", "page", "key"], "_i"), "sheets")
    first = numbered.groupBy("book").agg(F.min("_i").alias("_first"))
    parts = numbered.join(first, "book").withColumn("_part", F.floor((F.col("_i") - F.col("_first")) / most).cast("int"))
    parts = parts.withColumn("book", F.when(F.col("_part") == 0, F.col("book")).otherwise(F.concat_ws("-", "book", F.col("_part") + 1)))
    dealt = parts.repartition("book").sortWithinPartitions("book", "page", "_i").select("book", "sheet", "header", "kinds", "cells")
    _written(dealt, WorkbookSource, path)


def write_workbook(tables: dict[str, DataFrame], path: str, book: str, order: dict[str, str] | None = None, most: int = MOST_ROWS) -> None:
    """SNK5: a workbook with a sheet for each table, in the folder path; rows in order of a column if given. A table without rows has a sheet of its header. From `most` rows on the rest is in book-2.xlsx and so on."""
    rows = None
    for page, (sheet, df) in enumerate(tables.items()):
        first = (F.lit(book).alias("book"), F.lit(page).alias("page"), F.lit(sheet).alias("sheet"))
        by = (order or {}).get(sheet)
        own = _cells(df, df.columns, *first, F.struct((F.col(by).cast("string") if by and dict(df.dtypes)[by] == "string" else F.lit("")).alias("text"), (F.col(by).cast("double") if by and dict(df.dtypes)[by] != "string" else F.lit(0.0)).alias("number")).alias("key"))
        empty = df.sparkSession.range(1).select(*first, F.lit(None).cast(own.schema["key"].dataType).alias("key"), F.array(*(F.lit(c) for c in df.columns)).alias("header"), F.lit("").alias("kinds"), F.lit(None).cast("array<string>").alias("cells"))
        both = own.unionByName(empty)
        rows = both if rows is None else rows.unionByName(both)
    _save(rows, path, most)


def write_workbooks_by_key(df: DataFrame, path: str, key: str, *drop: str, order: str | None = None, most: int = MOST_ROWS) -> None:
    """SNK14 and SNK19: a workbook for each value of key, named by it, without some columns; rows in order of a column if given. Values that differ only in marks that file names lack share a workbook."""
    columns = [c for c in df.columns if c not in drop]
    by = F.col(order) if order else F.lit(0)
    _save(_cells(df, columns, _file_name(F.col(key)).alias("book"), F.lit(0).alias("page"), F.lit("datos").alias("sheet"), by.alias("key")), path, most)


# --- GeoJSON collections --------------------------------------------------------


class CollectionWriter(FilesWriter):
    """One GeoJSON file of all features (column value)."""

    def made(self, batches):
        name, out = self.hidden(), None
        for b in batches:
            for v in b.column(0).to_pylist():
                out = out or self.fs.open_output_stream(name)
                if out.tell():
                    out.write(b",\n")
                out.write(v.encode())
        if out is None:
            return []
        out.close()
        return [(name, "")]

    def named(self, fs, base, files):
        whole = f"{base}/.{uuid.uuid4().hex}.whole"
        with fs.open_output_stream(whole) as out:
            out.write(b'{"type":"FeatureCollection","features":[\n')
            for k, (part, _) in enumerate(files):
                if k:
                    out.write(b",\n")
                with fs.open_input_stream(part) as f:
                    while block := f.read(1 << 20):
                        out.write(block)
                fs.delete_file(part)
            out.write(b"\n]}\n")
        fs.move(whole, f"{base}/{self.options['file']}")


class CollectionSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geojson_collection"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return CollectionWriter(dict(self.options), schema)


def write_collection(df: DataFrame, path: str, file: str = "features.geojson", kinds: list[str] | None = None, box=BOX_POINT) -> None:
    """SNK1 and SNK2: one GeoJSON FeatureCollection in the folder path; only geometries of `kinds` if given; box as in features(). An empty table gives an empty collection."""
    if kinds:
        df = df.where(F.col("geometry.type").isin(*kinds))
    _written(features(df, box=box), CollectionSource, path, file=file)


# --- shape files ------------------------------------------------------------------

KINDS = {"Point": 1, "LineString": 3, "Polygon": 5}
_WIDTHS = {"n": ("N", 20, 0), "f": ("F", 24, 15), "s": ("C", 254, 0)}


def shape_body(kind: str, rings: list) -> bytes:
    """A record's content: a point, or the parts of a line or polygon with their box."""
    if kind == "Point":
        return struct.pack("<i2d", 1, *rings[0][0][:2])
    points = [p[:2] for r in rings for p in r]
    xs, ys = zip(*points, strict=True)
    starts, at = [], 0
    for r in rings:
        starts.append(at)
        at += len(r)
    return struct.pack(f"<i4d2i{len(rings)}i", KINDS[kind], min(xs), min(ys), max(xs), max(ys), len(rings), len(points), *starts) + struct.pack(f"<{2 * len(points)}d", *(v for p in points for v in p))


def read_body(body: bytes) -> tuple[str | None, list | None]:
    """Kind and parts of a record's content; heights and measures are left out, other kinds are null."""
    kind = struct.unpack_from("<i", body)[0]
    if kind % 10 == 1:
        return "Point", [[list(struct.unpack_from("<2d", body, 4))]]
    if kind % 10 in (3, 5):
        parts, n = struct.unpack_from("<2i", body, 36)
        starts = [*struct.unpack_from(f"<{parts}i", body, 44), n]
        xy = struct.unpack_from(f"<{2 * n}d", body, 44 + 4 * parts)
        return ("LineString" if kind % 10 == 3 else "Polygon"), [[[xy[2 * i], xy[2 * i + 1]] for i in range(a, b)] for a, b in zip(starts, starts[1:], strict=False)]
    return None, None


class ShapesWriter(FilesWriter):
    """A set of .shp, .shx, .dbf, .cpg and .prj for each task and kind: columns kind, rings and attributes."""

    def made(self, batches):
        fields = [f for f in self.schema.fields if f.name not in ("kind", "rings")]
        kinds = ["n" if isinstance(f.dataType, T.IntegralType) else "f" if isinstance(f.dataType, T.FractionalType) else "s" for f in fields]
        names = short_names([f.name for f in fields])
        sets: dict[str, dict] = {}
        for b in batches:
            columns = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
            for i, (kind, rings) in enumerate(zip(columns["kind"], columns["rings"], strict=True)):
                if kind not in KINDS or not rings or not rings[0]:
                    continue
                s = sets.get(kind)
                if s is None:
                    s = sets[kind] = {"n": 0, "at": 50, "index": [], "box": [math.inf, math.inf, -math.inf, -math.inf]}
                    for part in ("shp", "dbf"):
                        s[part + "_name"] = self.hidden()
                        s[part] = self.fs.open_output_stream(s[part + "_name"])
                body = shape_body(kind, rings)
                s["n"] += 1
                s["index"].append(struct.pack(">2i", s["at"], len(body) // 2))
                s["shp"].write(struct.pack(">2i", s["n"], len(body) // 2) + body)
                s["at"] += 4 + len(body) // 2
                for p in (p for r in rings for p in r):
                    s["box"] = [min(s["box"][0], p[0]), min(s["box"][1], p[1]), max(s["box"][2], p[0]), max(s["box"][3], p[1])]
                s["dbf"].write(b" " + b"".join(_field(columns[f.name][i], k) for f, k in zip(fields, kinds, strict=True)))
        out = []
        for kind, s in sets.items():
            s["shp"].close()
            s["dbf"].write(b"\x1a")
            s["dbf"].close()
            head = lambda words: struct.pack(">i5ii", 9994, 0, 0, 0, 0, 0, words) + struct.pack("<2i8d", 1000, KINDS[kind], *s["box"], 0, 0, 0, 0)  # noqa: B023, E731
            described = b"".join(struct.pack("<11sc4xBB14x", names[f.name].encode("ascii", "replace")[:10], _WIDTHS[k][0].encode(), _WIDTHS[k][1], _WIDTHS[k][2]) for f, k in zip(fields, kinds, strict=True))
            size = 1 + sum(_WIDTHS[k][1] for k in kinds)
            top = struct.pack("<4BIHH20x", 3, 125, 1, 1, s["n"], 33 + len(described), size) + described + b"\r"
            stem = f"{self.options['name']}-{kind.lower()}-{TaskContext.get().partitionId():05d}"
            for ext, first, rest in (("shp", head(s["at"]), s["shp_name"]), ("dbf", top, s["dbf_name"]), ("shx", head(50 + 4 * s["n"]), b"".join(s["index"])), ("cpg", b"UTF-8", b""), ("prj", self.options.get("prj", "").encode(), b"")):
                out.append((self._joined(first, rest), f"{stem}.{ext}"))
        return out

    def _joined(self, first: bytes, rest) -> str:
        """A file of a head, whose numbers are known only at the end, and what follows it."""
        name = self.hidden()
        with self.fs.open_output_stream(name) as out:
            out.write(first)
            if isinstance(rest, bytes):
                out.write(rest)
            else:
                with self.fs.open_input_stream(rest) as f:
                    while block := f.read(1 << 20):
                        out.write(block)
                self.fs.delete_file(rest)
        return name


def _field(v, kind: str) -> bytes:
    width = _WIDTHS[kind][1]
    if kind == "s":
        raw = ("" if v is None else str(v)).encode()
        while len(raw) > width:  # at a letter's end
            raw = raw[:width].decode("utf-8", "ignore").encode()
        return raw.ljust(width)
    return ("" if v is None else str(v) if kind == "n" else repr(float(v))).encode().rjust(width)[:width]


class Records(InputPartition):
    def __init__(self, file: str, first: int, n: int) -> None:
        super().__init__(first)
        self.file, self.first, self.n = file, first, n


SHAPES = "file string, number int, kind string, rings array<array<array<double>>>, attributes map<string,string>, prj string"


class ShapesReader(DataSourceReader):
    """Ranges of records as partitions, by the offsets of the .shx file; the .dbf file's rows have a fixed width."""

    def __init__(self, options: dict) -> None:
        self.path, self.step = options["path"], int(options.get("records", 50_000))

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs as pfs

        fs, base = place(self.path)
        info = fs.get_file_info(pfs.FileSelector(base)) if fs.get_file_info(base).type == pfs.FileType.Directory else [fs.get_file_info(base)]
        found = []
        for f in sorted(info, key=lambda f: f.path):
            if f.path.lower().endswith(".shp"):
                n = (fs.get_file_info(f"{f.path[:-4]}.shx").size - 100) // 8
                found += [Records(f.path, i, min(self.step, n - i)) for i in range(0, n, self.step)]
        return found or [Records("", 0, 0)]

    def read(self, partition: InputPartition):
        if not partition.n:
            return
        fs, _ = place(self.path)
        stem = partition.file[:-4]

        def whole(ext: str) -> str:
            try:
                with fs.open_input_stream(f"{stem}.{ext}") as f:
                    return f.read().decode("utf-8", "replace").strip()
            except FileNotFoundError:
                return ""

        coding, prj = whole("cpg") or "latin-1", whole("prj") or None
        with fs.open_input_file(f"{stem}.shx") as x, fs.open_input_file(partition.file) as s, fs.open_input_file(f"{stem}.dbf") as d:
            head = d.read(32)
            first, size = struct.unpack("<HH", head[8:12])
            described = d.read(first - 32)
            fields, at = [], 1
            for i in range(0, len(described) - 31, 32):
                if described[i] == 13:
                    break
                name, width = described[i : i + 11].split(b"\0")[0].decode("ascii", "replace"), described[i + 16]
                fields.append((name, at, at + width))
                at += width
            x.seek(100 + 8 * partition.first)
            places = struct.unpack(f">{2 * partition.n}i", x.read(8 * partition.n))
            d.seek(first + size * partition.first)
            for k in range(partition.n):
                s.seek(2 * places[2 * k])
                number, words = struct.unpack(">2i", s.read(8))
                kind, rings = read_body(s.read(2 * words))
                row = d.read(size)
                values = {n: row[a:b].decode(coding, "replace").strip() or None for n, a, b in fields}
                yield (partition.file, number, kind, rings, values, prj)


class ShapesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapes"

    def schema(self) -> str:
        return SHAPES

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ShapesReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ShapesWriter(dict(self.options), schema)


def read_shape_records(spark: SparkSession, path: str, records: int = 50_000) -> DataFrame:
    """SRC15 and SRC16: the records of a folder's shape files with their attributes (texts, null if blank) and projection, a task for each range of so many records."""
    spark.dataSource.register(ShapesSource)
    return spark.read.format("shapes").option("path", path).option("records", records).load()


def write_shapes(df: DataFrame, path: str, name: str = "shapes", prj: str = "") -> None:
    """SNK15: shape files, a set for each task and kind: df has kind (Point, LineString or Polygon) and rings (parts; of a point one of one vertex); its other columns are attributes, their names cut to 10 letters and texts to 254 bytes. Rows without such a geometry are left out."""
    keep = [F.col(c) if t in ("string", "tinyint", "smallint", "int", "bigint", "float", "double") else F.col(c).cast("string").alias(c) for c, t in df.dtypes if c != "rings"]
    _written(df.select(*keep, "rings"), ShapesSource, path, name=name, prj=prj)


def shapes_to_features(shapes: DataFrame) -> DataFrame:
    """SRC16: records of shape files as rows of features(): attributes and a geometry whose nesting follows its kind, as GeoJSON text."""
    coordinates = F.when(F.col("kind") == "Point", F.to_json(F.get(F.get("rings", 0), 0))).when((F.col("kind") == "LineString") & (F.size("rings") == 1), F.to_json(F.get("rings", 0))).otherwise(F.to_json("rings"))
    kind = F.when((F.col("kind") == "LineString") & (F.size("rings") > 1), "MultiLineString").otherwise(F.col("kind"))
    return shapes.select(F.concat(F.lit('{"type":"Feature","properties":'), F.to_json("attributes", {"ignoreNullFields": "false"}), F.lit(',"geometry":'), F.coalesce(F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), coordinates, F.lit("}")), F.lit("null")), F.lit("}")).alias("value"))
