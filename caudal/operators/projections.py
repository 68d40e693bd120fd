"""Coordinate systems by EPSG code, to and from WGS 84 degrees, by JVM expressions.

Transverse Mercator by Krueger's series to the sixth order (below a millimetre within
a zone and far beyond it), web Mercator, geographic systems, and changes of datum by
seven parameters through geocentric coordinates.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import once

#: Semi-major axis and inverse flattening (fixed values).
WGS84, GRS80, INTERNATIONAL_1924 = (6378137.0, 298.257223563), (6378137.0, 298.257222101), (6378388.0, 297.0)


@dataclass(frozen=True)
class System:
    kind: str  # geographic, transverse or web
    ellipsoid: tuple[float, float] = GRS80
    lat0: float = 0.0
    lon0: float = 0.0
    scale: float = 1.0
    east: float = 0.0
    north: float = 0.0
    #: To WGS 84: metres, arc seconds (position vector), parts in a million.
    shift: tuple[float, ...] = ()


#: Systems that the sources use (fixed values of the EPSG registry); UTM zones follow by rule.
SYSTEMS = {
    4326: System("geographic", WGS84),
    4686: System("geographic"),
    4218: System("geographic", INTERNATIONAL_1924, shift=(307.0, 304.0, -318.0, 0.0, 0.0, 0.0, 0.0)),
    3857: System("web", WGS84),
    3114: System("transverse", lat0=4.596200416666666, lon0=-80.07750791666666, east=1_000_000.0, north=1_000_000.0),
    3115: System("transverse", lat0=4.596200416666666, lon0=-77.07750791666666, east=1_000_000.0, north=1_000_000.0),
    3116: System("transverse", lat0=4.596200416666666, lon0=-74.07750791666666, east=1_000_000.0, north=1_000_000.0),
    3117: System("transverse", lat0=4.596200416666666, lon0=-71.07750791666666, east=1_000_000.0, north=1_000_000.0),
    3118: System("transverse", lat0=4.596200416666666, lon0=-68.07750791666666, east=1_000_000.0, north=1_000_000.0),
    9377: System("transverse", lat0=4.0, lon0=-73.0, scale=0.9992, east=5_000_000.0, north=2_000_000.0),
    21896: System("transverse", INTERNATIONAL_1924, 4.599047222222222, -77.08091666666667, 1.0, 1_000_000.0, 1_000_000.0, (307.0, 304.0, -318.0, 0.0, 0.0, 0.0, 0.0)),
    21897: System("transverse", INTERNATIONAL_1924, 4.599047222222222, -74.08091666666667, 1.0, 1_000_000.0, 1_000_000.0, (307.0, 304.0, -318.0, 0.0, 0.0, 0.0, 0.0)),
}


def system(code: int) -> System:
    """The system of an EPSG code; of UTM those of WGS 84, north and south."""
    if code in SYSTEMS:
        return SYSTEMS[code]
    zone = code % 100
    if code // 100 in (326, 327) and 1 <= zone <= 60:
        return System("transverse", WGS84, 0.0, 6.0 * zone - 183.0, 0.9996, 500_000.0, 0.0 if code < 32700 else 10_000_000.0)
    raise ValueError(f"EPSG:{code} is not known")


def utm_code(lat: float, lon: float) -> int:
    """The WGS 84 UTM zone of a place, without the exceptions of the far north."""
    return (32600 if lat >= 0 else 32700) + min(60, int((lon + 180) // 6) + 1)


def code_of_prj(text: str | None) -> int | None:
    """The EPSG code that a .prj file names: the last authority in it, else by its name; null if it tells neither."""
    found = re.findall(r'AUTHORITY\["EPSG",\s*"?(\d+)"?\]', text or "")
    if found:
        return int(found[-1])
    name = (re.match(r'\w+\["([^"]*)"', text or "") or [None, ""])[1].lower()
    zone = re.search(r"wgs_1984_utm_zone_(\d+)([ns])", name)
    if zone:
        return (32600 if zone[2] == "n" else 32700) + int(zone[1])
    by_name = {"wgs_1984_web_mercator_auxiliary_sphere": 3857, "gcs_wgs_1984": 4326, "gcs_magna": 4686, "magna_colombia_oeste": 3115, "magna_colombia_bogota": 3116, "magna_colombia_este": 3117, "magna-sirgas_origen-nacional": 9377}
    return by_name.get(name)


def _series(ellipsoid: tuple[float, float]) -> tuple[float, list[float], list[float]]:
    """The radius of the rectifying sphere, and Krueger's coefficients there and back (third flattening to the sixth order)."""
    n = 1 / (2 * ellipsoid[1] - 1)
    radius = ellipsoid[0] / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
    there = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 - 127 * n**5 / 288 + 7891 * n**6 / 37800,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 + 281 * n**5 / 630 - 1983433 * n**6 / 1935360,
        61 * n**3 / 240 - 103 * n**4 / 140 + 15061 * n**5 / 26880 + 167603 * n**6 / 181440,
        49561 * n**4 / 161280 - 179 * n**5 / 168 + 6601661 * n**6 / 7257600,
        34729 * n**5 / 80640 - 3418889 * n**6 / 1995840,
        212378941 * n**6 / 319334400,
    ]
    back = [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360 - 81 * n**5 / 512 + 96199 * n**6 / 604800,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440 + 46 * n**5 / 105 - 1118711 * n**6 / 3870720,
        17 * n**3 / 480 - 37 * n**4 / 840 - 209 * n**5 / 4480 + 5569 * n**6 / 90720,
        4397 * n**4 / 161280 - 11 * n**5 / 504 - 830251 * n**6 / 7257600,
        4583 * n**5 / 161280 - 108847 * n**6 / 3991680,
        20648693 * n**6 / 638668800,
    ]
    return radius, there, back


def _eccentricity(ellipsoid: tuple[float, float]) -> float:
    f = 1 / ellipsoid[1]
    return math.sqrt(f * (2 - f))


def _meridian(s: System) -> float:
    """How far the origin's latitude lies from the equator, in units of the sphere."""
    _, there, _ = _series(s.ellipsoid)
    e, phi = _eccentricity(s.ellipsoid), math.radians(s.lat0)
    t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
    xi = math.atan(t)
    return xi + sum(a * math.sin(2 * (j + 1) * xi) for j, a in enumerate(there))


def _onto_sphere(s: System, lat: Column, lon: Column) -> tuple[Column, Column]:
    e, phi, lam = _eccentricity(s.ellipsoid), F.radians(lat), F.radians(lon - s.lon0)
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    return F.atan2(t, F.cos(lam)), F.asinh(F.sin(lam) / F.sqrt(t * t + F.cos(lam) * F.cos(lam)))


def _to_plane(s: System, xi: Column, eta: Column) -> tuple[Column, Column]:
    radius, there, _ = _series(s.ellipsoid)
    x, y = eta, xi
    for j, a in enumerate(there, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    k = s.scale * radius
    return s.east + k * x, s.north + k * (y - _meridian(s))


def _to_conformal(s: System, x: Column, y: Column) -> tuple[Column, Column]:
    radius, _, back = _series(s.ellipsoid)
    k = s.scale * radius
    xi, eta = (y - s.north) / k + _meridian(s), (x - s.east) / k
    u, v = xi, eta
    for j, b in enumerate(back, 1):
        u = u - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        v = v - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return F.asin(F.sin(u) / F.cosh(v)), s.lon0 + F.degrees(F.atan2(F.sinh(v), F.cos(u)))


def _from_conformal(s: System, chi: Column, lon: Column) -> tuple[Column, Column]:
    n = 1 / (2 * s.ellipsoid[1] - 1)
    terms = [
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45 + 26 * n**5 / 45 - 2854 * n**6 / 675,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45 + 2704 * n**5 / 315 + 2323 * n**6 / 945,
        56 * n**3 / 15 - 136 * n**4 / 35 - 1262 * n**5 / 105 + 73814 * n**6 / 2835,
        4279 * n**4 / 630 - 332 * n**5 / 35 - 399572 * n**6 / 14175,
        4174 * n**5 / 315 - 144838 * n**6 / 6237,
        601676 * n**6 / 22275,
    ]
    phi = chi
    for j, d in enumerate(terms, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.degrees(phi), lon


def geocentric(lat: Column, lon: Column, ellipsoid: tuple[float, float]) -> tuple[Column, Column, Column]:
    """Metres from the earth's centre of a place on the ellipsoid."""
    e2, phi, lam = _eccentricity(ellipsoid) ** 2, F.radians(lat), F.radians(lon)
    r = ellipsoid[0] / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi))
    return r * F.cos(phi) * F.cos(lam), r * F.cos(phi) * F.sin(lam), r * (1 - e2) * F.sin(phi)


def geographic(x: Column, y: Column, z: Column, ellipsoid: tuple[float, float]) -> tuple[Column, Column]:
    """Degrees of a place near the ellipsoid, by Bowring's formula."""
    a, e2 = ellipsoid[0], _eccentricity(ellipsoid) ** 2
    b = a * math.sqrt(1 - e2)
    p = F.sqrt(x * x + y * y)
    theta = F.atan2(z * a, p * b)
    s, c = F.sin(theta), F.cos(theta)
    return F.degrees(F.atan2(z + e2 / (1 - e2) * b * s * s * s, p - e2 * a * c * c * c)), F.degrees(F.atan2(y, x))


def helmert(x: Column, y: Column, z: Column, shift: tuple[float, ...], back: bool = False) -> tuple[Column, Column, Column]:
    """Seven parameters as of a position vector; back undoes them (to first order in the small turns)."""
    sign = -1.0 if back else 1.0
    tx, ty, tz = (sign * v for v in shift[:3])
    rx, ry, rz = (sign * math.radians(v / 3600) for v in shift[3:6])
    m = 1 + sign * shift[6] * 1e-6
    return tx + m * (x - rz * y + ry * z), ty + m * (rz * x + y - rx * z), tz + m * (-ry * x + rx * y + z)


def _staged(df: DataFrame, x: Column, y: Column, steps: list) -> DataFrame:
    """df with _a and _b: x and y through steps (functions of columns), each computed once before the next uses it."""
    old = ["_a0", "_b0"]
    df = once(df, {"_a0": x.cast("double"), "_b0": y.cast("double")})
    for k, step in enumerate(steps, 1):
        new = [f"{n}{k}" for n in ("_a", "_b", "_c")]
        made = step(*(F.col(n) for n in old))
        df = once(df, dict(zip(new, made, strict=False))).drop(*old)
        old = new[: len(made)]
    return df.withColumnsRenamed({old[0]: "_a", old[1]: "_b"})


def _named(df: DataFrame, **columns: str) -> DataFrame:
    """df with _a and _b under new names, in place of columns that have these."""
    return df.drop(*columns.values()).withColumnsRenamed(columns)


def to_degrees(df: DataFrame, x: str, y: str, code: int, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """GE10: df with WGS 84 degrees from a system's coordinates (longitude or easting first); null where a coordinate is."""
    s = system(code)
    if s.kind == "web":
        r = s.ellipsoid[0]
        steps = [lambda a, b: (F.degrees(F.atan(F.sinh(b / r))), F.degrees(a / r))]
    elif s.kind == "geographic":
        steps = [lambda a, b: (b, a)]
    else:
        steps = [lambda a, b: _to_conformal(s, a, b), lambda u, v: _from_conformal(s, u, v)]
    if s.shift:
        steps += [lambda a, b: geocentric(a, b, s.ellipsoid), lambda *p: helmert(*p, s.shift), lambda *p: geographic(*p, WGS84)]
    return _named(_staged(df, F.col(x), F.col(y), steps), _a=lat, _b=lon)


def from_degrees(df: DataFrame, lat: str, lon: str, code: int, x: str = "x", y: str = "y") -> DataFrame:
    """GE10: df with a system's coordinates (longitude or easting first) from WGS 84 degrees; null where a coordinate is."""
    s = system(code)
    steps = [lambda a, b: geocentric(a, b, WGS84), lambda *p: helmert(*p, s.shift, back=True), lambda *p: geographic(*p, s.ellipsoid)] if s.shift else []
    if s.kind == "web":
        r = s.ellipsoid[0]
        steps.append(lambda a, b: (F.radians(b) * r, F.asinh(F.tan(F.radians(a))) * r))
    elif s.kind == "geographic":
        steps.append(lambda a, b: (b, a))
    else:
        steps += [lambda a, b: _onto_sphere(s, a, b), lambda xi, eta: _to_plane(s, xi, eta)]
    return _named(_staged(df, F.col(lat), F.col(lon), steps), _a=x, _b=y)
