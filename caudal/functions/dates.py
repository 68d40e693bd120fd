"""Dates, periods and what file names say about them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col, number, without

# Spanish month names, and the formats in the order they are tried.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")


def _date(y: Column, m: Column, d: Column) -> Column:
    text = F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.when(y.try_cast("int").between(1900, 2100), text.try_cast("date"))


def _found(s: Column, pattern: str, order: str) -> Column:
    at = {k: order.index(k) + 1 for k in "YMD"}
    part = lambda k: F.regexp_extract(s, pattern, at[k])
    return F.when(part("Y") != "", _date(part("Y"), part("M"), part("D")))


def date_search(c: Column | str) -> Column:
    """SF36: serial day numbers from 40000 to 60000, then d/m/y and y/m/d anywhere, then what ISO allows.

    Null for texts of over 50 characters, with over three letters, or unreadable.
    """
    s = F.trim(col(c))
    n = number(F.when(s.rlike(r"^\d+(\.\d+)?$"), s))
    serial = F.when(n.between(40000, 60000), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(n).cast("int")))
    found = F.coalesce(serial, _found(s, r"(\d{2})/(\d{2})/(\d{4})", "DMY"), _found(s, r"(\d{2})-(\d{2})-(\d{4})", "DMY"), _found(s, r"(\d{4})/(\d{2})/(\d{2})", "YMD"), _found(s, r"(\d{4})-(\d{2})-(\d{2})", "YMD"), s.try_cast("date"))
    return F.when((F.length(s) <= 50) & (F.length(without(s, r"[^\p{L}]")) <= 3), found)


def first_format(c: Column | str, formats: tuple[str, ...]) -> Column:
    """The timestamp by the first format that reads the text."""
    return F.coalesce(*(F.try_to_timestamp(F.trim(col(c)), F.lit(f)) for f in formats))


# Formats in the order they are tried.
ORDERED = ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy/MM/dd", "dd-MM-yyyy")
TEXTUAL = ("yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "MM/dd/yyyy", "yyyy/MM/dd", "dd.MM.yyyy", "dd/MM/yy", "yyyy-MM-dd HH:mm:ss")


def date_ordered(c: Column | str) -> Column:
    """SF37: the first fitting format decides, so d/m/y comes before m/d/y."""
    return first_format(c, ORDERED).cast("date")


def date_or_text(c: Column | str) -> Column:
    """SF38: as yyyy-MM-dd if one of eight formats fits, else the text as it is."""
    return F.coalesce(F.date_format(first_format(c, TEXTUAL), "yyyy-MM-dd"), col(c))


def date_iso(c: Column | str) -> Column:
    """SF39: ISO, else day first, as yyyy-MM-dd; else null."""
    return F.date_format(first_format(c, ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS", "dd/MM/yyyy", "dd-MM-yyyy")), "yyyy-MM-dd")


def month_number(c: Column | str) -> Column:
    """The month whose name the text holds, the first in the order of the year; null if none."""
    s = F.lower(col(c))
    return F.coalesce(*(F.when(s.contains(m), F.lit(i)) for i, m in enumerate(MONTHS, 1)))


def file_year(c: Column | str) -> Column:
    """SF42."""
    return F.regexp_extract(col(c), r"(20\d{2})", 1).try_cast("int")


def file_month(c: Column | str) -> Column:
    """SF42: month name."""
    return F.element_at(F.array(*(F.lit(m) for m in MONTHS)), month_number(c))


def file_period(c: Column | str) -> Column:
    """SF40: 'yyyy-MM' from a file name: quarter words before month names. 'i trimestre' is part of 'ii trimestre' and 'iii trimestre', so all three give 03."""
    s, y = F.lower(col(c)), file_year(c)
    quarter = F.when(s.contains("i trimestre") | s.contains("primer trimestre"), 3).when(s.contains("segundo trimestre"), 6).when(s.contains("tercer trimestre"), 9).when(s.contains("iv trimestre") | s.contains("cuarto trimestre"), 12)
    m = F.coalesce(quarter, month_number(c))
    return F.when(y.isNotNull() & m.isNotNull(), F.concat_ws("-", y.cast("string"), F.lpad(m.cast("string"), 2, "0")))


def period_end(tag: Column | str, year: Column | str) -> Column:
    """SF41: last day of the month that the tag names."""
    m = month_number(tag)
    first = F.concat_ws("-", col(year).cast("string"), F.lpad(m.cast("string"), 2, "0"), F.lit("01")).try_cast("date")
    return F.when(m.isNotNull() & col(year).isNotNull(), F.last_day(first))


def month_of(c: Column | str) -> Column:
    """SF43."""
    return F.date_trunc("month", col(c)).cast("date")


def quarter_of(c: Column | str) -> Column:
    """SF43."""
    return F.date_trunc("quarter", col(c)).cast("date")


def iso_week(c: Column | str) -> Column:
    """SF43: the ISO week, to be paired with the calendar year as the reports do."""
    return F.weekofyear(col(c))


def duration_days(start: Column | str, end: Column | str) -> Column:
    """SF44."""
    return F.datediff(col(end), col(start))
