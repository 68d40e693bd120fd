"""Text: casing, accents, codes, addresses, headers and identifiers."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col, swap, without

#: Letters with marks and the plain ones for them.
MARKED = "áàäâãåéèëêíìïîóòöôõúùüûñçýÁÀÄÂÃÅÉÈËÊÍÌÏÎÓÒÖÔÕÚÙÜÛÑÇÝ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyAAAAAAEEEEIIIIOOOOOUUUUNCY"
#: Words that stay small inside a title, and words that are written in capitals (fixed values).
CONNECTORS = ("a", "ante", "bajo", "con", "contra", "de", "del", "desde", "durante", "e", "el", "en", "entre", "hacia", "hasta", "la", "las", "lo", "los", "mediante", "mi", "o", "para", "por", "según", "sin", "sobre", "tras", "u", "y")
ACRONYMS = ("bpin", "cad", "covid", "dane", "dian", "dnp", "eps", "ie", "ips", "iva", "nit", "oit", "onu", "poa", "poai", "pqrs", "rrhh", "rut", "secop", "sgr", "sisben", "sst", "tic", "tio", "upid", "uts")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def plain(c: Column | str) -> Column:
    """Letters without accents."""
    return F.translate(col(c), MARKED, PLAIN)


def plain_upper(c: Column | str) -> Column:
    """SF26: no accents, capitals, single blanks; null is ''."""
    return F.coalesce(squeeze(F.upper(plain(c))), F.lit(""))


def plain_lower(c: Column | str) -> Column:
    """SF27: no accents, small letters, single blanks; null is ''."""
    return F.coalesce(squeeze(plain(F.lower(col(c)))), F.lit(""))


def _capital(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))


def title_es(c: Column | str) -> Column:
    """SF23: Spanish title case; connectors are small but in first place, acronyms are in capitals; a blank text stays."""
    words = F.split(F.trim(col(c)), r"\s+")

    def word(w: Column, i: Column) -> Column:
        bare = swap(F.lower(w), ".", "")
        return F.when(bare.isin(*ACRONYMS), F.upper(w)).when((i > 0) & bare.isin(*CONNECTORS), F.lower(w)).otherwise(_capital(w))

    return F.when(col(c).isNull() | (F.trim(col(c)) == ""), col(c)).otherwise(F.concat_ws(" ", F.transform(words, word)))


def title_reserved(c: Column | str, reserved: tuple[str, ...] = ("BIS",)) -> Column:
    """SF24: initial capitals, but reserved words in capitals as they are."""
    words = F.split(F.trim(col(c)), r"\s+")
    return F.when(col(c).isNotNull(), F.concat_ws(" ", F.transform(words, lambda w: F.when(F.upper(w).isin(*reserved), F.upper(w)).otherwise(_capital(w)))))


def district(c: Column | str) -> Column:
    """SF25: 'comuna 7' in any spelling becomes 'COMUNA 07'; other values stay, blank ones are null."""
    s = col(c)
    n = F.regexp_extract(s, r"(\d+)", 1).try_cast("int")
    return F.when(s == "", None).when(F.upper(s).contains("COMUNA") & n.isNotNull(), F.concat(F.lit("COMUNA "), F.when(n < 10, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string")))).otherwise(s)


#: Street words and what stands for them, in this order (fixed values).
STREET_WORDS = (("CARRERA", "CR"), ("CRA", "CR"), ("KRA", "CR"), ("KR", "CR"), ("CALLE", "CL"), ("CLL", "CL"), ("DIAGONAL", "DG"), ("TRANSVERSAL", "TV"), ("TRANSV", "TV"), ("AVENIDA", "AV"), ("NUMERO", ""), ("NRO", ""), ("NO.", ""), ("#", ""), ("Y", ""))


def address_key(c: Column | str) -> Column:
    """SF28: an address as a key: no accents, short street words, only letters and digits. Replacements are by substring, in order."""
    s = plain_upper(c)
    for a, b in STREET_WORDS:
        s = swap(s, a, b)
    return without(s, "[^A-Z0-9]")


def contract_reference(c: Column | str) -> Column:
    """SF29: no blanks around - and ., and none before a year, which gets a hyphen; blank is null."""
    s = squeeze(col(c))
    s = F.regexp_replace(F.regexp_replace(s, r"\s*-\s*", "-"), r"\s*\.\s*", ".")
    return F.nullif(F.regexp_replace(s, r"\s+(20\d{2})$", "-$1"), F.lit(""))


#: What UTF-8 letters look like when read as Latin-1; their pairs come from decoding the right letter wrongly.
_MOJIBAKE = {c.encode().decode("latin-1"): c for c in "áéíóúñüÁÉÍÓÚÑÜ°¿¡"}


def repair_encoding(c: Column | str) -> Column:
    """SF31: letters that were decoded with the wrong table."""
    s = col(c)
    for wrong, right in _MOJIBAKE.items():
        s = swap(s, wrong, right)
    return s


def printable(c: Column | str) -> Column:
    """SF32: without control characters other than tab and line ends."""
    return without(col(c), r"[\x00-\x08\x0B\x0C\x0E-\x1F]")


def blank_to_null(c: Column | str) -> Column:
    """SF58 and SF61: trimmed, blank or a null word as null."""
    s = F.trim(col(c))
    return F.when(~F.lower(s).isin("", "nan", "none", "null"), s)


def budget_code(c: Column | str) -> Column:
    """SF15: 'BP' and digits in capitals; bare digits get the prefix; others are null."""
    s = F.upper(F.trim(col(c)))
    found = F.regexp_extract(s, r"(BP\d+)", 1)
    return F.when(found != "", found).when(s.rlike(r"^\d+$"), F.concat(F.lit("BP"), s))


def valid_url(c: Column | str) -> Column:
    """SF34; null is false."""
    return F.coalesce(F.trim(col(c)).rlike(r"^https?://[^\s/$.?#][^\s]*$"), F.lit(False))


def safe_id(c: Column | str) -> Column:
    """SF35: letters, digits, - and _; runs of others become one underscore."""
    return F.regexp_replace(F.regexp_replace(plain(F.trim(col(c))), r"[^A-Za-z0-9_\-]+", "_"), r"^_+|_+$", "")


def contract_number(c: Column | str) -> Column:
    """SF59."""
    return F.upper(F.trim(col(c)))


def tax_number(c: Column | str) -> Column:
    """SF59: digits only, else null."""
    s = F.trim(col(c))
    return F.when(s.rlike("^[0-9]+$"), s)


def contract_value(c: Column | str) -> Column:
    """SF59: separators out; anything but digits left is 0."""
    s = without(F.trim(col(c)), r"[$.,\s]")
    return F.when(s.rlike("^[0-9]+$"), s.try_cast("bigint")).otherwise(F.lit(0))


# --- SF33: headers (plain Python over df.columns) ---------------------------


def _ascii(name: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFD", name) if unicodedata.category(ch) != "Mn")


def header_simple(name: str) -> str:
    return name.lower().strip().translate(str.maketrans({" ": "_", ".": "_", "(": None, ")": None}))


def header_budget(name: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9]", "_", _ascii(str(name)).lower())).strip("_")


def header_monitoring(name: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"[^\w]+", "_", _ascii(str(name).replace("\n", " ")).lower())).strip("_")


def header_contracts(name: str) -> str:
    return re.sub(r"\s+", "_", re.sub(r"[^\w\s]", "", _ascii(str(name)).lower()).strip())


def rename_all(df, rule):
    """Headers by rule; names that become equal get _2, _3 and so on."""
    seen: dict[str, int] = {}
    out = []
    for c in df.columns:
        n = rule(c) or "column"
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return df.toDF(*out)
