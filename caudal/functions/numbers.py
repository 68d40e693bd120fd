"""Money, percentages and other numbers out of dirty text.

Each variant is the rule set of one kind of source; they differ on purpose.
Inputs are strings (cast numbers first, or use the *_number forms). Nothing
throws: what cannot be read becomes the variant's default. Rounding is to the
even neighbour, as in the sources that these rules come from.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = ("-", "", "nan", "null", "NaN", "NULL", "None")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """The text as a double, or null."""
    return col(c).try_cast("double")


def without(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


def count_of(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def after_last(c: Column, char: str) -> Column:
    return F.substring_index(c, char, -1)


def swap(c: Column, a: str, b: str) -> Column:
    return F.replace(c, F.lit(a), F.lit(b))


def money(c: Column | str) -> Column:
    """SF1: dots or commas as thousands or decimals by position; a leading minus is dropped; unreadable is 0."""
    s = F.trim(col(c))
    t = F.regexp_replace(without(s, r"\$|COP|USD|[ \t]"), "^-", "")
    dot, comma = t.contains("."), t.contains(",")
    parts = count_of(t, ".") + 1
    plain = (
        F.when(dot & ~comma, F.when((parts > 2) | ((parts == 2) & (F.length(after_last(t, ".")) == 3)), swap(t, ".", "")).otherwise(t))
        .when(dot & comma, swap(t, ",", ""))
        .when(comma, F.when(F.length(after_last(t, ",")) <= 2, swap(t, ",", ".")).otherwise(swap(t, ",", "")))
        .otherwise(t)
    )
    value = F.when(s.isin(*BLANKS), F.lit(0.0)).otherwise(number(plain))
    return F.bround(F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0)), 2)


def money_number(c: Column | str) -> Column:
    """SF1 for a numeric column: negative or null is 0."""
    return F.bround(F.greatest(F.coalesce(F.nanvl(col(c).cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0)), 2)


def money_column(c: Column | str, as_integer: bool = False) -> Column:
    """SF2: SF1, as pesos without decimals if wanted."""
    m = money(c)
    return F.bround(m, 0).cast("bigint") if as_integer else m


def digits_only(c: Column | str) -> Column:
    """SF3 and SF8: the digits as a whole number; null without digits."""
    return without(col(c), "[^0-9]").try_cast("bigint")


def whole_number(c: Column | str) -> Column:
    """SF3 for mixed columns: numbers are truncated, infinite ones are 0, texts keep their digits; nothing readable is 0."""
    s = F.trim(col(c))
    n = number(F.when(s.rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"), s))
    return F.coalesce(n.try_cast("bigint"), digits_only(s), F.lit(0))


def currency(c: Column | str) -> Column:
    """SF4: dots alone are thousands, of both separators the last one is decimal, one comma before at most two characters is decimal; null if blank or unreadable."""
    s = F.trim(col(c))
    t = F.trim(swap(s, "$", ""))
    dot, comma = t.contains("."), t.contains(",")
    at = lambda ch: F.length(t) - F.length(after_last(t, ch))
    plain = (
        F.when(dot & ~comma, swap(t, ".", ""))
        .when(dot & comma, F.when(at(",") > at("."), swap(swap(t, ".", ""), ",", ".")).otherwise(swap(t, ",", "")))
        .when(comma, F.when((count_of(t, ",") == 1) & (F.length(after_last(t, ",")) <= 2), swap(t, ",", ".")).otherwise(swap(t, ",", "")))
        .otherwise(t)
    )
    empty = s.isin("$  -", "$ -", "-", "", "N/A", "n/a", "NULL", "null", "Sin información") | t.isin("", "-", "--")
    return F.when(~empty, number(plain))


def peso_integer(c: Column | str) -> Column:
    """SF5: without $, commas and blanks, only digits, points and minus signs, truncated; null is 0."""
    return F.coalesce(number(without(without(col(c), r"[$, ]"), r"[^0-9.\-]")).try_cast("bigint"), F.lit(0))


def peso_plain(c: Column | str) -> Column:
    """SF6: every $, comma, point and blank removed; unreadable is null."""
    return without(without(col(c), r"[$,. ]"), "(?i)nan").try_cast("bigint")


def numeric(c: Column | str) -> Column:
    """SF7: percentages keep their number; of both separators the last is decimal; a lone dot before over two characters is thousands; unreadable is 0."""
    s = F.trim(col(c))
    p = F.trim(swap(s, "%", ""))
    p1 = F.when(count_of(p, ",") == 1, swap(p, ",", ".")).otherwise(p)
    joined = lambda t: F.concat(swap(F.regexp_replace(t, r"\.[^.]*$", ""), ".", ""), F.lit("."), after_last(t, "."))
    percent = F.when(p1.contains(".") & s.contains(",") & (count_of(p1, ".") > 1), joined(p1)).otherwise(p1)
    t = F.trim(without(s, r"[$ ]"))
    dot, comma = t.contains("."), t.contains(",")
    at = lambda ch: F.length(t) - F.length(after_last(t, ch))
    plain = (
        F.when(dot & comma, F.when(at(",") > at("."), swap(swap(t, ".", ""), ",", ".")).otherwise(swap(t, ",", "")))
        .when(comma, F.when(after_last(t, ",").rlike(r"^\d{1,2}$"), swap(t, ",", ".")).otherwise(swap(t, ",", "")))
        .when(dot, F.when(count_of(t, ".") > 1, joined(t)).when(F.length(after_last(t, ".")) > 2, swap(t, ".", "")).otherwise(t))
        .otherwise(t)
    )
    value = F.when(s.contains("%"), number(percent)).otherwise(number(without(plain, r"[^\d.\-]")))
    return F.bround(F.coalesce(F.when(~s.isin("-", "", "nan", "NaN", "None"), value), F.lit(0.0)), 2)


def clip(c: Column | str, low: float, high: float) -> Column:
    """SF51: within [low, high]; null stays null."""
    return F.when(col(c).isNotNull(), F.least(F.greatest(col(c), F.lit(low)), F.lit(high)))


def _progress(c: Column | str, keep: str) -> Column:
    s = F.lower(F.trim(col(c)))
    t = without(swap(without(swap(s, "cero", "0"), r"[%$() ]"), ",", "."), f"[^{keep}]")
    first = F.substring_index(t, ".", 1)
    one = F.when(count_of(t, ".") > 1, F.concat(first, F.lit("."), swap(F.substring(t, F.length(first) + 2, F.length(t)), ".", ""))).otherwise(t)
    return F.bround(F.coalesce(clip(number(one), 0.0, 100.0), F.lit(0.0)), 2)


def progress(c: Column | str) -> Column:
    """SF9: percentage of progress in 0 to 100; 'cero' is 0; unreadable is 0."""
    return _progress(c, r"0-9.\-")


def progress_unsigned(c: Column | str) -> Column:
    """SF10: the same, minus signs ignored."""
    return _progress(c, "0-9.")


def ratio_to_percent(c: Column | str, any_above_one: Column) -> Column:
    """SF11: values in (0, 1] times 100. Where the column has values above one, too, only those are left as they are; any_above_one says so and only documents intent: both cases give the same rows."""
    v = col(c)
    return F.when((v > 0) & (v <= 1), v * 100).when(any_above_one, v).otherwise(v)


def or_zero(c: Column | str) -> Column:
    """SF12."""
    return F.coalesce(number(c), F.lit(0.0))


def integer(c: Column | str) -> Column:
    """SF13: truncated whole number or null."""
    return number(c).try_cast("bigint")


def budget_year(c: Column | str, first: int = 2024, last: int = 2030) -> Column:
    """SF13: years outside first to last, and unreadable ones, become first."""
    y = number(c).try_cast("int")
    return F.when(y.between(first, last), y).otherwise(F.lit(first))


def bpin(c: Column | str) -> Column:
    """SF14: struct(bpin text, bpin_num): digits with separators become a number, others stay text."""
    s = F.trim(col(c))
    bare = without(s, r"[.,\s]")
    digits = F.when(bare.rlike(r"^\d+$"), bare)
    return F.struct(F.when(s != "", F.coalesce(digits, s)).alias("bpin"), digits.try_cast("bigint").alias("bpin_num"))


def european_decimal(c: Column | str) -> Column:
    """SF57."""
    return number(swap(F.trim(col(c)), ",", "."))


def audit_money(c: Column | str) -> Column:
    """SF60: every separator but digits removed."""
    return F.coalesce(number(without(col(c), r"[^0-9]")), F.lit(0.0))


def audit_percent(c: Column | str) -> Column:
    """SF60: dots removed (so '12.5' is 125), comma as decimal point."""
    return F.coalesce(number(swap(swap(without(F.trim(col(c)), "[% ]"), ".", ""), ",", ".")), F.lit(0.0))


def centre_number(c: Column | str) -> Column:
    """SF61: without $, blanks and percent signs; of both separators the last is decimal; null if unreadable."""
    t = without(F.trim(col(c)), r"[$%\s]")
    at = lambda ch: F.length(t) - F.length(after_last(t, ch))
    both = t.contains(".") & t.contains(",")
    return number(F.when(both & (at(",") > at(".")), swap(swap(t, ".", ""), ",", ".")).when(both, swap(t, ",", "")).otherwise(swap(t, ",", ".")))


def quarterly_interest(balance: Column | str, base_rate: Column | str, spread: Column | str) -> Column:
    """SF45: balance times (base rate plus spread, in percent) for a quarter."""
    return col(balance) * (col(base_rate) + col(spread)) / 100 / 4


def execution(value: Column | str, paid: Column | str) -> dict[str, Column]:
    """SF46: percent executed, balance, difference and difference in percent; null where the value is 0."""
    v, p = col(value), col(paid)
    return {"pct_executed": F.try_divide(p * 100, v), "balance": v - p, "difference": p - v, "difference_pct": F.try_divide((p - v) * 100, v)}


def peso_text(c: Column | str) -> Column:
    """SF50: '$1.234.567'."""
    return F.concat(F.lit("$"), swap(F.format_number(col(c).cast("double"), 0), ",", "."))
