"""Workbooks, GeoJSON collections and shape files: written, read again, and the odd cases."""

import json
import os
import zipfile

import pytest

from caudal.sources import archives, documents, files


def test_workbook_of_several_sheets(spark, tmp_path):
    a = spark.createDataFrame([(2, 'b <&> "x"', 1.5, None), (1, " a\x00\n", float("nan"), [1]), (3, None, None, None)], "n int, `te xt` string, v double, l array<int>")
    none = spark.createDataFrame([], "only string")
    documents.write_workbook({"first/sheet": a, "first:sheet": a.limit(0), "none": none}, str(tmp_path), "book", {"first/sheet": "n"})
    assert os.listdir(tmp_path) == ["book.xlsx"]
    got = {(r.sheet, r.row): r.cells for r in archives.read_workbooks(spark, str(tmp_path)).collect()}
    assert got == {
        ("first_sheet", 1): ["n", "te xt", "v", "l"], ("first_sheet", 2): ["1", " a\n", "NaN", "[1]"], ("first_sheet", 3): ["2", 'b <&> "x"', "1.5"], ("first_sheet", 4): ["3"],
        ("first_sheet_2", 1): ["n", "te xt", "v", "l"], ("none", 1): ["only"],
    }
    with zipfile.ZipFile(tmp_path / "book.xlsx") as z:
        assert z.testzip() is None and len(z.namelist()) == 7


def test_workbooks_by_key(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "case when id % 3 = 0 then 'a/b' when id % 3 = 1 then 'c' end as key", "'x' as secret")
    documents.write_workbooks_by_key(df, str(tmp_path), "key", "secret", order="id", most=20)
    assert sorted(os.listdir(tmp_path)) == ["a_b-2.xlsx", "a_b.xlsx", "c-2.xlsx", "c.xlsx", "sin valor-2.xlsx", "sin valor.xlsx"]
    rows = archives.read_workbooks(spark, str(tmp_path)).where("row > 1").collect()
    assert sorted(int(r.cells[0]) for r in rows) == list(range(100)) and {len(r.cells) for r in rows} == {1, 2}
    first = sorted((r.row, int(r.cells[0])) for r in rows if r.path.endswith("/c.xlsx"))
    assert [i for _, i in first] == list(range(1, 60, 3))


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.range(0, 40, 1, 4).select(F.col("id"), F.when(F.col("id") == 35, F.raise_error(F.lit("no"))).otherwise(F.lit(1.0)).alias("lat"), F.lit(2.0).alias("lon"))
    with pytest.raises(Exception, match="no"):
        documents.write_collection(df, str(tmp_path / "out"))
    left = os.listdir(tmp_path / "out") if (tmp_path / "out").exists() else []
    assert "features.geojson" not in left


def test_collections(spark, tmp_path):
    df = spark.createDataFrame([(1, 3.4, -76.5, "é"), (2, None, None, None)], "k int, lat double, lon double, t string").repartition(3)
    documents.write_collection(df, str(tmp_path / "a"))
    made = json.loads((tmp_path / "a" / "features.geojson").read_text())
    assert made["type"] == "FeatureCollection" and sorted((f["properties"]["k"], f["geometry"]) for f in made["features"]) == [(1, {"type": "Point", "coordinates": [-76.5, 3.4]}), (2, None)]
    documents.write_collection(df.limit(0), str(tmp_path / "b"))
    assert json.loads((tmp_path / "b" / "features.geojson").read_text())["features"] == []
    assert os.listdir(tmp_path / "a") == ["features.geojson"]


def test_shapes(spark, tmp_path):
    ring = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]]
    hole = [[1.0, 0.5], [2.0, 0.5], [2.0, 1.0], [1.0, 0.5]]
    rows = [(1, "Point", [[[1.5, 2.5]]], "ñ" * 200, 0.1, None), (-7, "Polygon", [ring, hole], None, None, True), (3, "LineString", [ring[:2], hole[:3]], "x", 1e-7, False), (4, None, None, "y", 1.0, None), (5, "Curve", [ring], "z", 1.0, None)]
    df = spark.createDataFrame(rows, "a_rather_long_name int, kind string, rings array<array<array<double>>>, a_rather_long_text string, v double, b boolean").coalesce(1)
    documents.write_shapes(df, str(tmp_path), "s", "PROJCS[]")
    assert len(os.listdir(tmp_path)) == 15
    for n in (1, 100):
        got = {int(r.attributes["a_rather_l"]): r for r in documents.read_shape_records(spark, str(tmp_path), n).collect()}
        assert {k: (r.kind, r.rings, r.number, r.prj) for k, r in got.items()} == {k: (kind, rings, 1, "PROJCS[]") for k, kind, rings, *_ in rows[:3]}
        assert got[1].attributes["a_rather_1"] == "ñ" * 127 and got[-7].attributes["a_rather_1"] is None and float(got[3].attributes["v"]) == 1e-7 and got[-7].attributes["b"] == "true"
    kinds = {json.loads(r.value)["geometry"]["type"]: json.loads(r.value)["geometry"]["coordinates"] for r in documents.shapes_to_features(documents.read_shape_records(spark, str(tmp_path))).collect()}
    assert kinds == {"Point": [1.5, 2.5], "Polygon": [ring, hole], "MultiLineString": [ring[:2], hole[:3]]}
    assert {(r.kind, tuple(map(tuple, r.coordinates))) for r in archives.read_shapes(spark, str(tmp_path)).collect()} == {(kind, tuple(map(tuple, p))) for _, kind, rings, *_ in rows[:3] for p in rings}
    assert documents.read_shape_records(spark, str(tmp_path / "s-point-00000.shp")).count() == 1
    (tmp_path / "none").mkdir()
    assert documents.read_shape_records(spark, str(tmp_path / "none")).count() == 0


def test_scan_folder_reads_workbooks_and_notes_what_it_cannot(spark, tmp_path):
    (tmp_path / "a.csv").write_text("BPIN,Valor\n1,10\n")
    (tmp_path / "notes.docx").write_text("x")
    (tmp_path / "bad.xlsx").write_text("not a zip")
    (tmp_path / "_SUCCESS").write_text("")
    documents.write_workbook({"hoja": spark.createDataFrame([("2", 20)], "BPIN string, Valor int")}, str(tmp_path), "libro enero 2024")
    errors = []
    got = files.scan_folder(spark, str(tmp_path), errors=errors)
    assert sorted((r["bpin"], r["valor"], r["_archivo_origen"]) for r in got.collect()) == [("1", "10", "a.csv"), ("2", "20", "libro enero 2024.xlsx")]
    assert sorted(os.path.basename(p) for p, _ in errors) == ["bad.xlsx", "notes.docx"]
    with pytest.raises(ValueError, match="xlsx"):
        files.scan_folder(spark, str(tmp_path)).count()
    os.remove(tmp_path / "bad.xlsx")
    with pytest.warns(UserWarning, match="docx"):
        assert files.scan_folder(spark, str(tmp_path)).count() == 2
