"""Coordinates: reading, repair, distance and points. lat and lon are degrees of EPSG:4326."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import after_last, col, number, swap, without

EARTH_M = 6371000.0
#: The boxes differ by module on purpose: (least lat, greatest lat, least lon, greatest lon).
BOX_RULES, BOX_LIVE, BOX_SWAP, BOX_POINT, BOX_EXPORT = (3.35, 3.56, -76.60, -76.40), (3.3, 3.6, -76.7, -76.4), (3.25, 3.65, -76.70, -76.35), (2.5, 4.5, -77.5, -75.5), (2.0, 5.0, -78.0, -75.0)
#: Where GE2 to GE4 take a latitude for one, and a longitude without its sign.
BOX_SIGN = (2.5, 4.5, -77.5, -76.0)


def within(lat: Column | str, lon: Column | str, box: tuple[float, float, float, float]) -> Column:
    """PF14."""
    return col(lat).between(box[0], box[1]) & col(lon).between(box[2], box[3])


def decimal(c: Column | str) -> Column:
    """GE1: decimal comma or point; of both the last is decimal; blanks inside are left out."""
    s = F.trim(col(c))
    at = lambda ch: F.length(s) - F.length(after_last(s, ch))
    dot, comma = s.contains("."), s.contains(",")
    other = (
        F.when(comma & ~dot, swap(s, ",", "."))
        .when(comma & dot, F.when(at(",") > at("."), swap(swap(s, ".", ""), ",", ".")).otherwise(swap(s, ",", "")))
        .otherwise(without(s, " "))
    )
    return F.when(~F.lower(s).isin("", "nan", "none", "null"), F.coalesce(number(s), number(other)))


def decimal_separator(c: Column | str) -> Column:
    """GE23."""
    return number(swap(F.trim(col(c)), ",", "."))


def longitude(lon: Column | str, box=BOX_SIGN) -> Column:
    """GE2: 76.0 to 77.5, or what the box says, has lost its sign; -7.65 was -76.65."""
    x = col(lon)
    rebuilt = number(F.concat(F.lit("-76."), after_last(F.abs(x).cast("string"), ".")))
    short = (x > -10) & (x < 0) & F.abs(x).cast("string").rlike(r"^\d\.\d+$")
    return F.when(x.between(-box[3], -box[2]), -x).when(short & rebuilt.between(-77.5, -75.5), rebuilt).otherwise(x)


def latitude(lat: Column | str, box=BOX_SIGN) -> Column:
    """GE3: null outside 2.5 to 4.5, or what the box says."""
    return F.when(col(lat).between(box[0], box[1]), col(lat))


def pair(lat: Column | str, lon: Column | str, box=BOX_SIGN) -> Column:
    """GE4: struct(lat, lon), each normalised."""
    return F.struct(latitude(decimal(lat), box).alias("lat"), longitude(decimal(lon), box).alias("lon"))


def corrected(lat: Column | str, lon: Column | str, box=BOX_SWAP) -> Column:
    """GE5: struct(lat, lon, corrections, warnings, is_valid); a pair that lies in the box once it is turned is swapped."""
    a, b = decimal_separator(lat), decimal_separator(lon)
    null = a.isNull() | b.isNull()
    absurd = (F.abs(a) > 1000) | (F.abs(b) > 1000)
    inverted = within(b, a, box)
    x, y = F.when(inverted, b).otherwise(a), F.when(inverted, a).otherwise(b)
    changed = (col(lat).cast("string") != a.cast("string")) | (col(lon).cast("string") != b.cast("string"))
    some = lambda *cs: F.filter(F.array(*(F.when(F.coalesce(w, F.lit(False)), F.lit(n)) for w, n in cs)), lambda v: v.isNotNull())
    ok = ~null & ~F.coalesce(absurd, F.lit(False))
    return F.struct(
        F.when(ok, x).alias("lat"),
        F.when(ok, y).alias("lon"),
        some((changed, "decimal_separator"), (ok & inverted, "inverted_coordinates")).alias("corrections"),
        some((null, "null"), (absurd, "absurd"), (ok & (F.abs(a) > 90), "lat_out_of_range"), (ok & (F.abs(b) > 180), "lon_out_of_range"), (ok & ~within(x, y, box), "outside_area")).alias("warnings"),
        ok.alias("is_valid"),
    )


def repaired_lat(c: Column | str) -> Column:
    """GE6: a fraction alone gets its 3."""
    x = number(swap(without(F.trim(col(c).cast("string")), " "), ",", "."))
    return F.bround(F.when(x.between(2.5, 4.5), x).when((x > 0) & (x < 1), 3.0 + x), 10)


def repaired_lon(c: Column | str) -> Column:
    """GE6: a positive value is turned, a fraction alone gets its -76."""
    x = number(swap(without(F.trim(col(c).cast("string")), " "), ",", "."))
    return F.bround(F.when(x.between(-77.5, -75.5), x).when((x > 75.5) & (x < 77.5), -x).when((x > 0) & (x < 1), -76.0 - x), 10)


def rescaled(c: Column | str, kind: str) -> Column:
    """GE7: a number beyond any degree gets its decimal point after the first digit (lat) or the first two (lon)."""
    x = number(col(c).cast("string"))
    pos, most = (2, 180) if kind == "lon" else (1, 90)
    digits = F.abs(F.bround(x, 0)).cast("decimal(38,0)").cast("string")
    moved = number(F.concat(F.substring(digits, 1, pos), F.lit("."), F.substring(digits, pos + 1, 40)))
    return F.when((F.abs(x) <= most) | (F.length(digits) <= pos), x).otherwise(F.signum(x) * moved)


def from_dms(c: Column | str, kind: str) -> Column:
    """GE8: degrees, minutes and seconds run together; null if they are none or lead outside the area."""
    x = col(c).cast("double")
    low, high = (2.5, 4.5) if kind == "lat" else (-77.5, -75.5)
    whole = F.floor(F.abs(x)).cast("decimal(38,0)").cast("string")
    rest = F.abs(x) - F.floor(F.abs(x))
    part = lambda a, b: F.reverse(F.substring(F.reverse(whole), a, b)).try_cast("double")
    seconds, minutes = part(1, 2) + rest, part(3, 2)
    dms = F.when((minutes < 60) & (seconds < 60), part(5, 40) + minutes / 60 + seconds / 3600)
    dm = F.when(part(1, 2) + rest < 60, part(3, 40) + (part(1, 2) + rest) / 60)
    out = F.signum(x) * F.when(F.abs(x) >= 1_000_000, dms).when(F.abs(x) >= 1000, dm)
    return F.when(x.between(low, high), x).when(out.between(low, high), out)


def point(lat: Column | str, lon: Column | str, box=BOX_POINT) -> Column:
    """GE9: a GeoJSON-like point, null outside the box; box None: of any place."""
    return F.when(within(lat, lon, box) if box else col(lat).isNotNull() & col(lon).isNotNull(), F.struct(F.lit("Point").alias("type"), F.array(col(lon).cast("double"), col(lat).cast("double")).alias("coordinates")))


def haversine_m(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    """GE11: metres."""
    a, b, c, d = (F.radians(col(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), F.lit(2)) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), F.lit(2))
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def from_text(c: Column | str) -> Column:
    """NJ9: a point out of 'lon, lat'."""
    p = F.split(col(c), ",")
    lon, lat = number(F.trim(F.try_element_at(p, F.lit(1)))), number(F.trim(F.try_element_at(p, F.lit(2))))
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")))


def flat2d(coordinates: Column | str, levels: int = 0) -> Column:
    """NJ6: coordinates without height; levels: 0 for a point, 1 for a line, 2 for a polygon, 3 for several."""
    c = col(coordinates)
    if levels == 0:
        return F.slice(c, 1, 2)
    return F.transform(c, lambda x: flat2d(x, levels - 1))


def wkt(kind: str, coordinates: Column | str) -> Column:
    """NJ7: Point, LineString or Polygon as text."""
    one = lambda p: F.concat_ws(" ", p[0].cast("string"), p[1].cast("string"))
    line = lambda ps: F.concat(F.lit("("), F.concat_ws(", ", F.transform(ps, one)), F.lit(")"))
    c = col(coordinates)
    body = {"Point": lambda: F.concat(F.lit("("), one(c), F.lit(")")), "LineString": lambda: line(c), "Polygon": lambda: F.concat(F.lit("("), F.concat_ws(", ", F.transform(c, line)), F.lit(")"))}[kind]()
    return F.concat(F.lit(f"{kind.upper()} "), body)


def lat_lon_of(geometry: Column | str) -> dict[str, Column]:
    """NJ10: of a point struct."""
    g = col(geometry)
    at = lambda i: F.when(g["type"] == "Point", F.try_element_at(g["coordinates"], F.lit(i)))
    return {"lat": at(2), "lon": at(1)}
