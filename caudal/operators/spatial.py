"""Points, lines and polygons: joins by grid cell, proximity clusters, validation.

Polygons are rows with `rings`: array of rings, each an array of [lon, lat] whose
last point is the first; holes are further rings. Joins go by equality of
quadtree cells, of which each holds only the edges that touch it, then by the
exact test; nothing is compared with everything.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.coords import haversine_m
from ..shared import cut, drop

#: Quadtree of polygon covers: the widest cell in degrees and the number of levels. The grid starts off any round number, so that no vertex lies on its lines.
ROOT, LEVELS, ORIGIN = 0.64, 8, -0.0037281946352817
#: Edges of a cell from which on it is split.
EDGES = 8


class Cover:
    """Quadtree cover of one polygon: cells wholly inside, and cells with the edges that touch them.

    Of a cell without edges all points are in or all are out. Elsewhere a point is
    led within its cell to the corner in the south-east, whose side is known:
    east to the cell's side, then south along it. Each edge crossed on the way changes the side, and
    all of these touch the cell.
    """

    def __init__(self, rings: list) -> None:
        ends = [(*a[:2], *b[:2]) for r in rings if r is not None for a, b in zip(r[:-1], r[1:], strict=True)]
        self.e = np.array(ends, float).reshape(-1, 4)
        self.cells: list[tuple] = []
        if not len(self.e):
            return
        x, y = self.e[:, [0, 2]], self.e[:, [1, 3]]
        at = lambda v: int(np.floor((v - ORIGIN) / ROOT))
        for cx in range(at(x.min()), at(x.max()) + 1):
            for cy in range(at(y.min()), at(y.max()) + 1):
                x0, y0 = ORIGIN + cx * ROOT, ORIGIN + cy * ROOT
                odd = self._east(np.arange(len(self.e)), x0 + ROOT, y0, math.inf) % 2
                self._split(0, cx, cy, np.arange(len(self.e)), odd)

    def _east(self, k: np.ndarray, x: float, y: float, to: float) -> int:
        """Edges k that a ray from (x, y) east to `to` crosses."""
        x1, y1, x2, y2 = self.e[k].T
        with np.errstate(divide="ignore", invalid="ignore"):
            at = (x2 - x1) * (y - y1) / (y2 - y1) + x1
            return int((((y1 > y) != (y2 > y)) & (x < at) & (at <= to)).sum())

    def _south(self, k: np.ndarray, x: float, y: float, to: float) -> int:
        """Edges k that a line from (x, y) south to `to` crosses."""
        x1, y1, x2, y2 = self.e[k].T
        with np.errstate(divide="ignore", invalid="ignore"):
            at = (y2 - y1) * (x - x1) / (x2 - x1) + y1
            return int((((x1 > x) != (x2 > x)) & (at <= y) & (to < at)).sum())

    def _touching(self, k: np.ndarray, x0: float, y0: float, size: float) -> np.ndarray:
        x1, y1, x2, y2 = self.e[k].T
        pad = size * 1e-9
        box = (np.minimum(x1, x2) <= x0 + size + pad) & (np.maximum(x1, x2) >= x0 - pad) & (np.minimum(y1, y2) <= y0 + size + pad) & (np.maximum(y1, y2) >= y0 - pad)
        # Corners all on one side of the line leave the box alone.
        corners = [(x2 - x1) * (v - y1) - (y2 - y1) * (u - x1) for u in (x0 - pad, x0 + size + pad) for v in (y0 - pad, y0 + size + pad)]
        return k[box & (np.min(corners, 0) <= 0) & (np.max(corners, 0) >= 0)]

    def _split(self, level: int, cx: int, cy: int, k: np.ndarray, odd: int) -> None:
        size = ROOT / 2**level
        x0, y0 = ORIGIN + cx * size, ORIGIN + cy * size
        k = self._touching(k, x0, y0, size)
        if not len(k):
            if odd:
                self.cells.append((level, cx, cy, True, x0 + size, y0, []))
        elif len(k) <= EDGES or level == LEVELS - 1:
            self.cells.append((level, cx, cy, bool(odd), x0 + size, y0, self.e[k].tolist()))
        else:
            for dx in (0, 1):
                for dy in (0, 1):
                    x, y = x0 + (dx + 1) * size / 2, y0 + dy * size / 2
                    self._split(level + 1, 2 * cx + dx, 2 * cy + dy, k, (odd + self._east(k, x, y, x0 + size) + self._south(k, x0 + size, y, y0)) % 2)


def cover(polygons: DataFrame, name: str = "name") -> tuple[DataFrame, list[int]]:
    """The cells of polygons (name, rings), and the levels that occur: _name, level, cx, cy, side (of its corner), east, south, edges."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(n, *c) for n, rings in zip(b["_name"], b["rings"], strict=True) if rings is not None for c in Cover(rings).cells]
            yield pd.DataFrame(rows, columns=["_name", "level", "cx", "cy", "side", "east", "south", "edges"])

    kind = polygons.schema[name].dataType.simpleString()
    found = polygons.select(F.col(name).alias("_name"), "rings").mapInPandas(run, f"_name {kind}, level int, cx long, cy long, side boolean, east double, south double, edges array<array<double>>")
    found = cut(found, "cover")
    return found, sorted(r[0] for r in found.select("level").distinct().collect())


def _size(level: Column) -> Column:
    return ROOT / F.pow(F.lit(2.0), level)


def _cell(v: Column, level: Column) -> Column:
    return F.floor((v - ORIGIN) / _size(level)).cast("long")


def _in_cell(x: Column, y: Column) -> Column:
    """Whether a point of a cell of cover() is in its polygon."""

    def crossed(e: Column) -> Column:
        x1, y1, x2, y2 = (e[i] for i in range(4))
        east, south = F.col("east"), F.col("south")
        at = (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1
        down = (y2 - y1) * (east - x1) / F.nullif(x2 - x1, F.lit(0.0)) + y1
        one = lambda c: F.when(c, 1).otherwise(0)
        return one(((y1 > y) != (y2 > y)) & (x < at) & (at <= east)) + one(((x1 > east) != (x2 > east)) & (down <= y) & (south < down))

    return F.aggregate("edges", F.when(F.col("side"), 1).otherwise(0), lambda n, e: n + crossed(e)) % 2 == 1


def _hits(points: DataFrame, cells: DataFrame, levels: list[int]) -> DataFrame:
    """points with the _name of each polygon that they (_x, _y) are in."""
    level = F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>"))
    p = points.withColumn("level", level)
    p = p.withColumns({"cx": _cell(F.col("_x"), F.col("level")), "cy": _cell(F.col("_y"), F.col("level"))})
    return p.join(cells, ["level", "cx", "cy"]).where(_in_cell(F.col("_x"), F.col("_y")))


def points_in_polygons(points: DataFrame, polygons: DataFrame, lon: str, lat: str, key: str, name: str = "name", first_only: bool = True) -> DataFrame:
    """JN10, JN13 and GE20: each point with the name of the polygon that it is within, null if none; of several the first by name."""
    p = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(key, F.col(lon).cast("double").alias("_x"), F.col(lat).cast("double").alias("_y"))
    hits = _hits(p, *cover(polygons, name))
    hits = hits.groupBy(key).agg(F.min("_name").alias(f"in_{name}")) if first_only else hits.select(key, F.col("_name").alias(f"in_{name}")).distinct()
    return points.join(hits, key, "left")


def _segments_cross(p, q, a, b) -> Column:
    side = lambda u, v, w: (v[0] - u[0]) * (w[1] - u[1]) - (v[1] - u[1]) * (w[0] - u[0])
    return (side(p, q, a) * side(p, q, b) <= 0) & (side(a, b, p) * side(a, b, q) <= 0)


def lines_in_polygons(lines: DataFrame, polygons: DataFrame, line: str, key: str, name: str = "name", first_only: bool = False) -> DataFrame:
    """JN11, and JN12 with first_only: pairs (key, polygon) of lines, or of points as lines of one vertex, that meet a polygon: a vertex inside, or a segment that crosses an edge. Segments on one line with an edge count if their boxes meet."""
    cells, levels = cover(polygons, name)
    own = lines.where(F.size(line) > 0).select(key, F.col(line).alias("_l"))
    vertices = own.select(key, F.explode("_l").alias("_p")).select(key, F.col("_p")[0].cast("double").alias("_x"), F.col("_p")[1].cast("double").alias("_y"))
    inside = _hits(vertices, cells, levels).select(key, "_name")
    steps = F.when(F.size("_l") >= 2, F.sequence(F.lit(0), F.size("_l") - 2)).otherwise(F.array().cast("array<int>"))
    parts = own.select(key, "_l", F.explode(steps).alias("_i")).select(key, F.col("_l")[F.col("_i")].alias("_p"), F.col("_l")[F.col("_i") + 1].alias("_q"))
    parts = parts.withColumn("level", F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")))
    # Along x, the cells over which a segment passes: of each column those between its heights at the column's sides.
    ((x1, y1), (x2, y2)), level = ((F.col(c)[0], F.col(c)[1]) for c in ("_p", "_q")), F.col("level")
    lo, hi = F.least(x1, x2), F.greatest(x1, x2)
    height = lambda x: F.when(x1 == x2, y1).otherwise(y1 + (y2 - y1) * (F.least(F.greatest(x, lo), hi) - x1) / F.nullif(x2 - x1, F.lit(0.0)))
    parts = parts.withColumn("cx", F.explode(F.sequence(_cell(lo, level), _cell(hi, level))))
    west = F.col("cx") * _size(level) + ORIGIN
    a, b = height(west), height(west + _size(level))
    steep = x1 == x2
    low, high = F.when(steep, F.least(y1, y2)).otherwise(F.least(a, b)), F.when(steep, F.greatest(y1, y2)).otherwise(F.greatest(a, b))
    parts = parts.withColumn("cy", F.explode(F.sequence(_cell(low - 1e-9, level), _cell(high + 1e-9, level))))
    edges = cells.where(F.size("edges") > 0).select("_name", "level", "cx", "cy", "edges")
    end = lambda e, i: F.array(e[i], e[i + 1])
    crossing = F.exists("edges", lambda e: _segments_cross(F.col("_p"), F.col("_q"), end(e, 0), end(e, 2)))
    hits = parts.join(edges, ["level", "cx", "cy"]).where(crossing).select(key, "_name").union(inside)
    if first_only:
        return lines.join(hits.groupBy(key).agg(F.min("_name").alias(f"in_{name}")), key, "left")
    return hits.select(key, F.col("_name").alias(f"in_{name}")).distinct()


def near_pairs(points: DataFrame, key: str, lat: str, lon: str, metres: float) -> DataFrame:
    """JN14: pairs (a, b, metres) with a < b of points within so many metres, by latitude bands and cells as wide as the distance.

    Points on either side of the date line are not paired.
    """
    step = metres / 111_000.0
    width = lambda band: F.lit(step) / F.cos(F.radians(F.least(F.lit(89.9), (F.abs(band) + 2) * step)))
    p = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(key).alias("k"), F.col(lat).cast("double").alias("y"), F.col(lon).cast("double").alias("x"))
    p = p.withColumn("band", F.floor(F.col("y") / step).cast("long"))
    right = p.select(F.col("k").alias("b"), F.col("y").alias("y2"), F.col("x").alias("x2"), "band", F.floor(F.col("x") / width(F.col("band"))).cast("long").alias("cell"))
    left = p.select("k", "y", "x", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"))
    left = left.withColumn("at", F.floor(F.col("x") / width(F.col("band"))).cast("long")).select(F.col("k").alias("a"), "y", "x", "band", F.explode(F.sequence(F.col("at") - 1, F.col("at") + 1)).alias("cell"))
    d = haversine_m(F.col("y"), F.col("x"), F.col("y2"), F.col("x2"))
    return left.join(right, ["band", "cell"]).where(F.col("a") < F.col("b")).select("a", "b", d.alias("metres")).where(F.col("metres") <= metres)


def connected(links: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of links (a, b): comp is the smallest node reachable. Labels spread along links and jump along labels until none changes; two numbers a round reach the driver."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = cut(both, "links")
    label = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("comp")), "label")
    while True:
        around = both.join(label.select(F.col("a").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        new = label.join(around, "a").select("a", F.least("comp", "m").alias("c"))
        jump = new.join(label.select(F.col("a").alias("c"), F.col("comp").alias("j")), "c", "left").select("a", F.least("c", F.coalesce("j", "c")).alias("comp"))
        jump = cut(jump, "label")
        moved = jump.join(label.withColumnRenamed("comp", "old"), "a").where(F.col("old") != F.col("comp")).limit(1).count()
        drop(label)
        label = jump
        if not moved:
            drop(both)
            return label.select(F.col("a").alias("node"), "comp")


#: A cell is split into SPLIT by SPLIT boxes a level; after DEEP levels a box is a place.
SPLIT, DEEP = 8, 5


def _box_metres(near: bool) -> Column:
    """The least (near) or greatest distance of two boxes of columns a_ and b_; of two places their distance."""
    c = F.col
    gap = lambda lo, hi: F.greatest(F.lit(0.0), c(f"b_{lo}") - c(f"a_{hi}"), c(f"a_{lo}") - c(f"b_{hi}"))
    reach = lambda lo, hi: F.greatest(c(f"b_{hi}") - c(f"a_{lo}"), c(f"a_{hi}") - c(f"b_{lo}"))
    dy, dx = (gap if near else reach)("y1", "y2"), (gap if near else reach)("x1", "x2")
    # The nearer the pole, the shorter a degree of longitude.
    far = lambda s: F.greatest(F.abs(c(f"{s}_y1")), F.abs(c(f"{s}_y2")))
    low = lambda s: F.when((c(f"{s}_y1") <= 0) & (c(f"{s}_y2") >= 0), 0.0).otherwise(F.least(F.abs(c(f"{s}_y1")), F.abs(c(f"{s}_y2"))))
    at = far if near else low
    half = lambda d: F.pow(F.sin(F.radians(d) / 2), F.lit(2))
    return 2 * 6371000.0 * F.asin(F.sqrt(F.least(F.lit(1.0), half(dy) + F.cos(F.radians(at("a"))) * F.cos(F.radians(at("b"))) * half(dx))))


def _cells_within(points: DataFrame, metres: float) -> DataFrame:
    """points (k, y, x) with their cell (band, col), whose points are all within so many metres of each other, and their box of the finest level (v, u) in it."""
    side = metres / math.sqrt(2) * (1 - 1e-9) / 6371000.0 * 180 / math.pi
    fine = SPLIT**DEEP
    p = points.withColumn("band", F.floor(F.col("y") / side).cast("long"))
    p = p.withColumn("wide", side / _narrowest(F.col("band"), side))
    p = p.withColumn("col", F.floor(F.col("x") / F.col("wide")).cast("long"))
    part = lambda v, first, size: F.least(F.lit(fine - 1), F.greatest(F.lit(0), F.floor((v - first * size) / size * fine).cast("int")))
    return p.select("k", "y", "x", "band", "col", part(F.col("y"), F.col("band"), F.lit(side)).alias("v"), part(F.col("x"), F.col("col"), F.col("wide")).alias("u"))


def _narrowest(band: Column, side: float) -> Column:
    """The cosine of a band's latitude nearest the equator."""
    return F.cos(F.radians(F.least(F.lit(89.9), F.least(F.abs(band), F.abs(band + 1)) * side)))


def _boxes(p: DataFrame, level: int, side: str) -> DataFrame:
    """The boxes of a level with their extents, under names of one side, and their parents."""
    shift = lambda c, n: F.shiftright(c, 3 * (DEEP - n)) if n <= DEEP else F.col(c)
    ids = ["band", "col", shift("v", level - 1).alias("pv"), shift("u", level - 1).alias("pu"), shift("v", level).alias("cv"), shift("u", level).alias("cu")]
    if level > DEEP:  # places
        ids += [F.col("y").alias("cy"), F.col("x").alias("cx")]
    out = p.groupBy(*ids).agg(F.min("y").alias("y1"), F.max("y").alias("y2"), F.min("x").alias("x1"), F.max("x").alias("x2"))
    return out.select(*(F.col(c).alias(f"{side}_{c}") for c in ("band", "col", "pv", "pu", "cv", "cu", "y1", "y2", "x1", "x2")))


def _cell_links(p: DataFrame, cells: DataFrame, metres: float) -> DataFrame:
    """(a, b): cells, by their first keys, of which a point of one is within so many metres of a point of the other.

    Boxes around the cells' points decide most pairs: near enough as a whole, or
    too far. The others are looked at box by box, a level deeper each round, until
    boxes are places. No pair of points is made but at the last level, for boxes
    of which only their very places can decide.
    """
    side = metres / math.sqrt(2) * (1 - 1e-9) / 6371000.0 * 180 / math.pi
    reach = metres / 6371000.0 * 180 / math.pi
    names = ("band", "col", "n", "y1", "y2", "x1", "x2")
    a, b = (cells.select(*(F.col(c).alias(f"{s}_{c}") for c in names)) for s in "ab")
    a = a.withColumn("to", F.explode(F.sequence(F.col("a_band"), F.col("a_band") + 2)))
    wide = side / _narrowest(F.col("to"), side)
    more = reach / F.cos(F.radians(F.least(F.lit(89.9), F.greatest(F.abs(F.col("a_band")), F.abs(F.col("to") + 1)) * side + side))) * 1.0001
    a = a.withColumn("at", F.explode(F.sequence(F.floor((F.col("a_x1") - more) / wide).cast("long"), F.floor((F.col("a_x2") + more) / wide).cast("long"))))
    pairs = a.join(b, (F.col("to") == F.col("b_band")) & (F.col("at") == F.col("b_col"))).where((F.col("a_band") < F.col("b_band")) | (F.col("a_col") < F.col("b_col")))
    keep = ["a_n", "b_n", "near", *(f"{s}_{c}" for s in "ab" for c in ("band", "col", "cv", "cu"))]
    judged = lambda df: df.where(_box_metres(True) <= metres).withColumn("near", _box_metres(False) <= metres).select(*keep)
    open_ = cut(judged(pairs.withColumns({f"{s}_{c}": F.lit(0) for s in "ab" for c in ("cv", "cu")})), "cells")
    links = None
    for level in range(1, DEEP + 2):
        near = open_.where("near").select("a_n", "b_n").distinct()
        links = near if links is None else links.union(near)
        rest = open_.join(near, ["a_n", "b_n"], "left_anti")
        if not rest.limit(1).count():
            return links.select(F.col("a_n").alias("a"), F.col("b_n").alias("b"))
        for s in "ab":
            parent = [f"{s}_band", f"{s}_col", f"{s}_pv", f"{s}_pu"]
            rest = rest.withColumnsRenamed({f"{s}_cv": f"{s}_pv", f"{s}_cu": f"{s}_pu"}).join(_boxes(p, level, s), parent)
        open_ = cut(judged(rest), "cells")
    return links.union(open_.where("near").select("a_n", "b_n").distinct()).select(F.col("a_n").alias("a"), F.col("b_n").alias("b"))


def proximity_clusters(points: DataFrame, key: str, lat: str, lon: str, metres: float = 40.0) -> DataFrame:
    """GE12: points with cluster_geo: the smallest key of all points that a chain of steps of so many metres leads to; null without coordinates.

    Points of one cell, whose diagonal is that distance, are one node of the graph,
    however many they are; neighbouring cells are linked by _cell_links. Points on
    either side of the date line are not linked.
    """
    placed = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(key).alias("k"), F.col(lat).cast("double").alias("y"), F.col(lon).cast("double").alias("x"))
    p = cut(_cells_within(placed, metres), "points")
    cells = cut(p.groupBy("band", "col").agg(F.min("k").alias("n"), *(f(c).alias(f"{c}{i}") for c in "yx" for i, f in ((1, F.min), (2, F.max)))), "cell-boxes")
    comp = connected(_cell_links(p, cells, metres))
    of_cell = cells.join(comp, F.col("n") == F.col("node"), "left").select("band", "col", F.coalesce("comp", "n").alias("cluster_geo"))
    named = p.join(of_cell, ["band", "col"]).select(F.col("k").alias(key), "cluster_geo")
    return points.join(named.distinct(), key, "left")


def split_clusters(clustered: DataFrame, key: str, *names: str) -> DataFrame:
    """GE13: within a cluster a part for each combination of names in order of first row; combinations with a null stay with the first."""
    first = clustered.where(F.col("cluster_geo").isNotNull()).groupBy("cluster_geo", *names).agg(F.min(key).alias("_f"))
    part = F.dense_rank().over(W.partitionBy("cluster_geo").orderBy("_f")) - 1
    for n in names:
        part = F.when(F.col(n).isNull(), 0).otherwise(part)
    first = first.withColumn("part", part)
    cond = F.col("l.cluster_geo") == F.col("r.cluster_geo")
    for n in names:
        cond = cond & F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}"))
    return clustered.alias("l").join(first.alias("r"), cond, "left").select("l.*", F.col("r.part").alias("part"))


def validation_label(in_district: Column, district: Column, in_quarter: Column, quarter: Column) -> Column:
    """GE19."""
    return F.when(F.coalesce((in_district == district) | (in_quarter == quarter), F.lit(False)), "ACEPTABLE").otherwise("FUERA DE RANGO")


def ring_problem(ring: Column) -> Column:
    """GE22: why a ring is not valid: too few points, not closed, or two edges that cross; null if it is."""
    n = F.size(ring)
    edges = F.sequence(F.lit(0), n - 2)
    crossing = F.exists(edges, lambda i: F.exists(edges, lambda j: (j > i + 1) & ~((i == 0) & (j == n - 2)) & _strict(ring[i], ring[i + 1], ring[j], ring[j + 1])))
    return F.when(n < 4, "too few points").when(ring[0] != ring[n - 1], "not closed").when(crossing, "self-intersection")


def _strict(p, q, a, b) -> Column:
    side = lambda u, v, w: (v[0] - u[0]) * (w[1] - u[1]) - (v[1] - u[1]) * (w[0] - u[0])
    return (side(p, q, a) * side(p, q, b) < 0) & (side(a, b, p) * side(a, b, q) < 0)


def to_degrees(df: DataFrame, x: str, y: str, false_easting: float, false_northing: float, lat0: float, lon0: float, scale: float = 1.0) -> DataFrame:
    """GE10: transverse Mercator metres to EPSG:4326 degrees, by the usual series (GRS80); good to centimetres within a zone."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = f * (2 - f)
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    m = lambda lat: a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * lat - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * lat) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * lat) - 35 * e2**3 / 3072 * math.sin(6 * lat))
    mu = (m(math.radians(lat0)) + (F.col(y) - false_northing) / scale) / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    phi = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + 151 * e1**3 / 96 * F.sin(6 * mu)
    ep = e2 / (1 - e2)
    c, t = ep * F.pow(F.cos(phi), F.lit(2)), F.pow(F.tan(phi), F.lit(2))
    w = 1 - e2 * F.pow(F.sin(phi), F.lit(2))
    n, r = a / F.sqrt(w), a * (1 - e2) / F.pow(w, F.lit(1.5))
    d = (F.col(x) - false_easting) / (n * scale)
    lat = phi - n * F.tan(phi) / r * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep) * F.pow(d, F.lit(4)) / 24)
    lon = (d - (1 + 2 * t + c) * F.pow(d, F.lit(3)) / 6) / F.cos(phi)
    return df.withColumns({"lat": F.degrees(lat), "lon": lon0 + F.degrees(lon)})
