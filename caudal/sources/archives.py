"""Workbooks, KMZ archives and shape files, read as bytes by Spark and unpacked in its tasks, one file at a time.

A file is held whole by one task, as these formats have no parts that could be
read alone; folders of many files spread over the cluster.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import header_budget
from .files import best_header

ROWS = "path string, sheet string, row int, cells array<string>"
PLACES = "path string, name string, kind string, coordinates array<array<double>>"


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _column(ref: str) -> int:
    """A1 is 0, B7 is 1, AA3 is 26."""
    n = 0
    for ch in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def _text(e) -> str:
    return "".join(t.text or "" for t in e.iter() if _local(t.tag) == "t")


def workbook_rows(data: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row from 1, cells as texts) of a workbook; dates are the numbers that the workbook holds."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = [_text(e) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        links = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in (e for e in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if _local(e.tag) == "sheet"):
            target = links[next(v for k, v in sheet.attrib.items() if _local(k) == "id" and k != "sheetId")].lstrip("/")
            with z.open(target if target.startswith("xl/") else f"xl/{target}") as f:
                for _, row in ElementTree.iterparse(f):
                    if _local(row.tag) != "row":
                        continue
                    cells: list[str | None] = []
                    for c in row:
                        at = _column(c.get("r")) if c.get("r") else len(cells)
                        cells += [None] * (at + 1 - len(cells))
                        v = next((x.text for x in c if _local(x.tag) == "v"), None)
                        kind = c.get("t")
                        cells[at] = shared[int(v)] if kind == "s" and v is not None else _text(c) if kind == "inlineStr" else v
                    yield sheet.get("name"), int(row.get("r") or 0), cells
                    row.clear()


def kmz_places(data: bytes) -> Iterator[tuple[str | None, str, list[list[float]]]]:
    """(name, kind, [lon, lat] pairs) of each placemark of a KMZ or KML file."""
    if data[:2] == b"PK":
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            data = z.read(next(n for n in z.namelist() if n.lower().endswith(".kml")))
    for mark in (e for e in ElementTree.fromstring(data).iter() if _local(e.tag) == "Placemark"):
        name = next((e.text for e in mark if _local(e.tag) == "name"), None)
        for shape in (e for e in mark.iter() if _local(e.tag) in ("Point", "LineString", "LinearRing")):
            points = [[float(x) for x in p.split(",")[:2]] for e in shape.iter() if _local(e.tag) == "coordinates" for p in (e.text or "").split()]
            yield name, {"LinearRing": "Polygon"}.get(_local(shape.tag), _local(shape.tag)), points


def shape_places(data: bytes) -> Iterator[tuple[str | None, str, list[list[float]]]]:
    """(record number, kind, [x, y] pairs) of each part of each record of a .shp file: points, lines and polygons, with heights left out."""
    at = 100
    while at + 12 <= len(data):
        number, words = struct.unpack(">ii", data[at : at + 8])
        body = data[at + 8 : at + 8 + 2 * words]
        at += 8 + 2 * words
        kind = struct.unpack("<i", body[:4])[0] % 10
        if kind == 1:
            yield str(number), "Point", [list(struct.unpack("<2d", body[4:20]))]
        elif kind in (3, 5):
            parts, points = struct.unpack("<2i", body[36:44])
            starts = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), points]
            xy = struct.unpack(f"<{2 * points}d", body[44 + 4 * parts : 44 + 4 * parts + 16 * points])
            for a, b in zip(starts, starts[1:], strict=False):
                yield str(number), "LineString" if kind == 3 else "Polygon", [[xy[2 * i], xy[2 * i + 1]] for i in range(a, b)]


def _unpacked(spark: SparkSession, path: str, glob: str, read, schema: str) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in schema.split(", ")]
        for f in frames:
            for where, data in zip(f["path"], f["content"], strict=True):
                rows = [(where, *r) for r in read(bytes(data))]
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content").mapInPandas(run, schema)


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """SRC3, SRC4, SRC6, SRC21, SRC22: every row of every sheet of a folder's workbooks, or of one: path, sheet, row, cells."""
    return _unpacked(spark, path, "*.xlsx", workbook_rows, ROWS)


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None, normalise=header_budget) -> DataFrame:
    """SRC3 and SRC5: one sheet of the workbooks as a table of texts. The header is the row that looks most like one among the first 15 of the first workbook by path; without `sheet`, the sheet whose header looks best is read. Only those rows reach the driver."""
    rows = read_workbooks(spark, path)
    top = rows.where(F.col("row") <= 15).select("path", "sheet", "row", "cells")
    if sheet:
        top = top.where(F.col("sheet") == sheet)
    first = top.agg(F.min("path")).first()[0]
    if first is None:
        raise FileNotFoundError(f"no such sheet in {path}")
    sheets: dict[str, list] = {}
    for r in top.where(F.col("path") == first).orderBy("sheet", "row").collect():
        sheets.setdefault(r.sheet, []).append((r.row, r.cells))
    from .files import header_score

    best = max(sorted(sheets), key=lambda k: max(header_score(c) for _, c in sheets[k]))
    row, header = sheets[best][best_header([c for _, c in sheets[best]])]
    seen: dict[str, int] = {}
    names = []
    for i, h in enumerate(header):
        n = normalise(h) if h and h.strip() else f"column_{i}"
        seen[n] = seen.get(n, 0) + 1
        names.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    body = rows.where((F.col("sheet") == best) & (F.col("row") > row) & F.exists("cells", lambda x: F.coalesce(F.trim(x), F.lit("")) != ""))
    return body.select(F.element_at(F.split("path", "/"), -1).alias("_archivo_origen"), F.col("row").alias("_fila"), *(F.get("cells", i).alias(n) for i, n in enumerate(names)))


def read_kmz(spark: SparkSession, path: str) -> DataFrame:
    """SRC16: the placemarks of KMZ and KML files: path, name, kind, coordinates."""
    return _unpacked(spark, path, "*.km[lz]", kmz_places, PLACES)


def read_shapes(spark: SparkSession, path: str) -> DataFrame:
    """SRC15 and SRC16: the geometries of shape files (.shp), a row for each part; coordinates are in the file's own system (spatial.to_degrees turns metres)."""
    return _unpacked(spark, path, "*.shp", shape_places, PLACES)
