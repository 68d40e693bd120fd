"""Column functions on literal values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from caudal.functions import coords, dates, nested, numbers, status, text


@pytest.fixture(scope="module")
def check(spark):
    def run(f, cases, kind="string"):
        df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], f"i int, x {kind}")
        got = [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]
        assert got == [y for _, y in cases], list(zip(cases, got, strict=True))

    return run


def test_money(check):
    check(numbers.money, [("155.521.600", 155521600.0), ("$224,436,000.00", 224436000.0), ("1.234", 1234.0), ("12.5", 12.5), ("1,5", 1.5), ("1,234", 1234.0), ("-500", 500.0), ("-", 0.0), ("", 0.0), (None, 0.0), ("abc", 0.0), ("COP 1 000", 1000.0), ("--5", 0.0), (".", 0.0)])
    check(numbers.money_number, [(-500.0, 0.0), (None, 0.0), (1.005, 1.0), (float("nan"), 0.0)], "double")
    check(lambda c: numbers.money_column(c, True), [("2,5", 2), ("3,5", 4), (None, 0)])


def test_other_numbers(check):
    check(numbers.digits_only, [("$1.234,5", 12345), ("x", None), (None, None)])
    check(numbers.whole_number, [("12.9", 12), ("-3", -3), ("$ 1.000", 1000), ("x", 0), (None, 0)])
    check(numbers.currency, [("5.370.000", 5370000.0), ("1.234.567,89", 1234567.89), ("1,234,567.89", 1234567.89), ("1234,89", 1234.89), ("1,234,567", 1234567.0), ("$ -", None), ("N/A", None), ("", None)])
    check(numbers.peso_integer, [("$ 1,234.7", 1234), (None, 0), ("x", 0)])
    check(numbers.numeric, [("45,5%", 45.5), ("1.234,56", 1234.56), ("1,234.56", 1234.56), ("1,5", 1.5), ("1.5", 1.5), ("1.500", 1500.0), ("1.2.3", 12.3), ("-", 0.0), (None, 0.0)])
    check(numbers.progress, [("cero", 0.0), ("45,5%", 45.5), ("(30)", 30.0), ("120", 100.0), ("-5", 0.0), ("1.2.3", 1.23), (None, 0.0), ("nan", 0.0)])
    check(numbers.progress_unsigned, [("-5", 5.0)])
    check(numbers.budget_year, [("2019", 2024), ("2026", 2026), (None, 2024), ("x", 2024)])
    check(lambda c: numbers.bpin(c)["bpin"], [("2.024.760", "2024760"), ("AB-1", "AB-1"), ("", None), (None, None)])
    check(numbers.audit_percent, [("12.5", 125.0), ("3,5 %", 3.5)])
    check(numbers.centre_number, [("1.234,5", 1234.5), ("x", None)])
    check(numbers.peso_text, [(1234567.0, "$1.234.567"), (0.0, "$0")], "double")


def test_text(check):
    check(text.title_es, [("casa DE la ips", "Casa de la IPS"), ("de paso", "De Paso"), ("i.e. san JUAN y cía.", "I.E. San Juan y Cía."), ("  ", "  "), (None, None)])
    check(text.plain_upper, [(" Ñandú  é ", "NANDU E"), (None, "")])
    check(text.district, [("comuna 7", "COMUNA 07"), ("Comuna\n12", "COMUNA 12"), ("El Hormiguero", "El Hormiguero"), ("", None), (None, None)])
    check(text.repair_encoding, [("AdecuaciÃ³n", "Adecuación")])
    check(text.printable, [("a\x00b\tc\x1f", "ab\tc")])
    check(text.budget_code, [("bp 1", None), (" bp12 ", "BP12"), ("77", "BP77"), ("x", None)])
    check(text.contract_reference, [(" CD - 4 . 2  2025", "CD-4.2-2025"), ("", None)])
    check(text.valid_url, [("https://a.b/c", True), ("a.b", False), (None, False)])
    check(text.safe_id, [(" Secretaría / 1 ", "Secretaria_1")])
    check(text.tax_number, [(" 900 ", "900"), ("9-1", None)])
    assert text.header_budget("Código  Centro.Gestor") == "codigo_centro_gestor"


def test_dates(check):
    d = date(2025, 1, 15)
    check(dates.date_search, [("15/01/2025", d), ("15-01-2025", d), ("2025/01/15", d), ("2025-01-15", d), ("45000", date(2023, 3, 15)), ("pendiente", None), (None, None), ("1" * 51, None), ("31/02/2025", None)])
    check(dates.date_ordered, [("05/06/2024", date(2024, 6, 5)), ("12/31/2024", date(2024, 12, 31)), ("x", None)])
    check(dates.date_or_text, [("05/06/2024", "2024-06-05"), ("pronto", "pronto")])
    check(dates.file_period, [("Seguimiento I Trimestre 2024.xlsx", "2024-03"), ("II Trimestre 2024", "2024-03"), ("IV trimestre 2024", "2024-12"), ("junio_2023.csv", "2023-06"), ("x", None)])
    check(lambda c: dates.period_end(c, F.lit(2024)), [("EJECUCION FEBRERO", date(2024, 2, 29)), ("x", None)])


def test_status(spark):
    rows = [("", None, "En alistamiento"), (None, "50", "En ejecución"), ("suspendido", "100", "Suspendido"), ("Terminado", "0", "En alistamiento"), ("otra cosa", "cero", "En alistamiento"), ("Entregado", None, "Terminado"), ("rara", None, "En ejecución"), ("Socialización", "x", "En alistamiento"), ("en obra", "100", "Terminado")]
    df = spark.createDataFrame(rows, "s string, p string, want string")
    assert [r for r in df.withColumn("got", status.status("s", "p")).collect() if r.got != r.want] == []


def test_coordinates(spark, check):
    table = [("3.440123", "76.494757", 3.440123, -76.494757), ("3.443499", "76.532927", 3.443499, -76.532927), ("3.369127", "-7.650763", 3.369127, -76.650763), ("3,440123", "-76,532927", 3.440123, -76.532927), ("34550800868900000", "-76.535201", None, -76.535201), ("3.4", "-76.5", 3.4, -76.5), (None, None, None, None), ("", "", None, None)]
    df = spark.createDataFrame(table, "a string, b string, lat double, lon double").withColumn("p", coords.pair("a", "b"))
    assert all((r.p.lat, r.p.lon) == (r.lat, r.lon) for r in df.collect())
    r = spark.createDataFrame([("-76,5", "3,4")], "a string, b string").select(coords.corrected("a", "b").alias("c")).first().c
    assert (r.lat, r.lon, r.corrections, r.is_valid) == (3.4, -76.5, ["decimal_separator", "inverted_coordinates"], True)
    check(lambda c: coords.rescaled(c, "lat"), [("34512345", 3.4512345), ("3.4", 3.4)])
    check(lambda c: coords.rescaled(c, "lon"), [("-765123456", -76.5123456)])
    check(lambda c: coords.from_dms(c, "lat"), [(32630.0, None), (3263000.0, None), (3.4, 3.4), (32630.0, None)], "double")
    check(coords.repaired_lon, [("0,53", -76.53), ("76.5", -76.5), ("5", None)])
    check(lambda c: coords.wkt("Point", F.array(c, c)), [(1.5, "POINT (1.5 1.5)")], "double")


def test_coordinates_of_another_box(spark):
    box = (0.0, 90.0, -180.0, 0.0)
    df = spark.createDataFrame([("12,4", "85.5"), ("-12,4", "-85.5")], "a string, b string").select(coords.pair("a", "b", box).alias("p"), coords.corrected(F.lit("-85.5"), F.lit("12.4"), box).alias("c"))
    assert [(r.p.lat, r.p.lon) for r in df.collect()] == [(12.4, -85.5), (None, -85.5)]
    assert {(r.c.lat, r.c.lon, *r.c.corrections, *r.c.warnings) for r in df.collect()} == {(12.4, -85.5, "inverted_coordinates")}


def test_references(check):
    check(nested.references, [('["a", " b "]', ["a", "b"]), ("a, b,", ["a", "b"]), ("http://x/a,b", ["http://x/a,b"]), ("one", ["one"]), ("nan", None), ("", None), (None, None), ("[1, 2", ["[1", "2"])])
    check(nested.comma_list, [("a, ,b", ["a", "b"]), (None, None)])
