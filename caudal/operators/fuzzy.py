"""Text similarity, matching to catalogs, and fuzzy groups.

Similarities have no JVM form: alike.py joins by arrays, catalogs are matched over
distinct values only.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import plain_lower, plain_upper
from ..shared import cut
from .alike import greedy_alike, sequence_join, similarity_join
from .spatial import connected
from .windows import global_ids


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for ch in b:
        m = s & where.get(ch, 0)
        s = ((s + m) | (s - m)) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    """Share of two texts' letters that insertions and deletions leave alone, in percent."""
    n = len(a) + len(b)
    return 200.0 * common_subsequence(a, b) / n if n else 100.0


def token_set(a: str, b: str) -> float:
    """The best ratio between the shared words alone and with either text's other words; 100 if one holds all words of the other."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    left = f"{both} {' '.join(sorted(x - y))}".strip()
    right = f"{both} {' '.join(sorted(y - x))}".strip()
    best = ratio(left, right)
    return max(best, ratio(both, left), ratio(both, right)) if both else best


def similarity(a: str | None, b: str | None) -> float:
    """GE14: 0.4 times ratio plus 0.6 times token_set; 0 if either text is empty."""
    return 0.4 * ratio(a, b) + 0.6 * token_set(a, b) if a and b else 0.0


def best_match(value: str, keys: list[str], cutoff: float) -> str | None:
    """The key of the greatest block ratio from cutoff on; ties go to the greatest key."""
    best = None
    m = SequenceMatcher()
    m.set_seq2(value)
    for k in keys:
        m.set_seq1(k)
        if m.real_quick_ratio() >= cutoff and m.quick_ratio() >= cutoff:
            r = m.ratio()
            if r >= cutoff and (best is None or (r, k) > best):
                best = (r, k)
    return best[1] if best else None


def match_catalog(df: DataFrame, column: str, catalog: list[str], name: str, cutoff: float = 0.85) -> DataFrame:
    """JN19, GE18, GE21 and QD13: the catalog's value for each text: equal without accents and case, else the most similar from cutoff on, else null.

    Each distinct text is compared once; the catalog is a list in code.
    """
    keys = {}
    for v in catalog:
        keys.setdefault(_upper(v), v)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hit = [keys.get(n) or keys.get(best_match(n, list(keys), cutoff) or "") for n in b["_n"]]
            yield pd.DataFrame({"_v": b["_v"], name: pd.Series(hit, dtype="object")})

    values = df.where(F.nullif(F.trim(F.col(column)), F.lit("")).isNotNull()).select(F.col(column).alias("_v")).distinct().withColumn("_n", plain_upper("_v"))
    matched = values.mapInPandas(run, f"_v string, `{name}` string")
    return df.join(matched, F.col(column) == F.col("_v"), "left").drop("_v")


def _upper(text: str) -> str:
    from ..functions.text import MARKED, PLAIN

    return " ".join(text.translate(str.maketrans(MARKED, PLAIN)).upper().split())


def fuzzy_pairs(df: DataFrame, key: str, text: str, least: float, most: float = 100.1, shared: int = 0) -> DataFrame:
    """JN15: pairs (a, b, similarity), a < b, with least <= similarity < most; with shared, only among texts that share so many words. Null and empty texts have no pairs."""
    t = df.select(F.col(key).alias("k"), plain_lower(text).alias("t")).where("t != ''")
    return similarity_join(t, least, shared).where(F.col("similarity") < most)


def potential_duplicates(df: DataFrame, key: str, text: str, least: float = 0.8) -> DataFrame:
    """JN22: pairs (a, b, similarity), a < b, of texts in lower case whose block ratio is over least and under 1. Null and empty texts have no pairs."""
    return sequence_join(df.select(F.col(key).alias("k"), F.lower(text).alias("t")).where("t != ''"), least).where(F.col("similarity") < 1)


def fuzzy_clusters(df: DataFrame, key: str, name: str, detail: str, address: str, threshold: float = 85.0, mode: str = "exact") -> DataFrame:
    """GE15: df with cluster_fuzzy.

    mode 'exact': the order-dependent greedy grouping by key, its groups numbered from 0 in order of their first rows. mode 'connected': connected components of similar rows, named by their smallest key; differs where similarity is not transitive. Rows are similar if their names are by threshold, or names and addresses by 0.7 of it. A null name or detail counts as the word 'nan', as in the sources; a row without a name is alone.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit("nan"))
    rows = df.select(F.col(key).alias("k"), plain_lower(F.concat_ws(" ", text(name), text(detail))).alias("name"), F.coalesce(plain_lower(address), F.lit("")).alias("address"))
    # Rows of one name and address are linked alike: the first stands for all of them.
    same = cut(rows.where("name != ''").groupBy("name", "address").agg(F.min("k").alias("k")), "same")
    if mode == "exact":
        found = greedy_alike(same, threshold).select(F.col("k").alias("n"), F.col("opener").alias("c"))
    else:
        found = connected(_links(same, threshold)).select(F.col("node").alias("n"), F.col("comp").alias("c"))
    named = same.join(found, F.col("k") == F.col("n")).select("name", "address", "c")
    out = rows.join(named, ["name", "address"], "left").select("k", F.coalesce("c", "k").alias("c"))
    if mode == "exact":
        out = cut(out, "groups")
        out = out.join(global_ids(out.select("c").distinct(), ["c"], "cluster_fuzzy", -1), "c").select("k", "cluster_fuzzy")
    return df.join(out.select(F.col("k").alias(key), F.col("cluster_fuzzy" if mode == "exact" else "c").alias("cluster_fuzzy")), key, "left")


def _links(same: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of rows (k, name, address), each name and address once, that fuzzy_clusters takes as similar; rows of one name by way of its first row."""
    names, places = (same.groupBy(F.col(c).alias("t")).agg(F.min("k").alias("k")) for c in ("name", "address"))
    strong = cut(similarity_join(names, threshold).select("a", "b"), "near-names")
    # Names under the threshold link rows by their addresses only, so names without any need no pairs.
    placed = same.where("address != ''").select("name").distinct().join(names, F.col("name") == F.col("t")).select("k", "t")
    near = similarity_join(placed, 0.7 * threshold)
    at = similarity_join(places.where("t != ''"), 0.7 * threshold).select("a", "b")
    at = cut(at.union(at.select("b", "a")).union(places.where("t != ''").select("k", "k")), "near-places")
    nodes = same.join(names.select(F.col("t").alias("name"), F.col("k").alias("u")), "name").join(places.select(F.col("t").alias("address"), F.col("k").alias("p")), "address").select("k", "u", "p")
    nodes = cut(nodes, "nodes")
    node = lambda k, u, p: nodes.select(F.col("k").alias(k), F.col("u").alias(u), F.col("p").alias(p))
    weak = near.where(F.col("similarity") < threshold).select(F.col("a").alias("u"), F.col("b").alias("v"))
    weak = weak.join(node("x", "u", "p"), "u").join(at.select(F.col("a").alias("p"), F.col("b").alias("q")), "p").join(node("y", "v", "q"), ["v", "q"]).select(F.col("x").alias("a"), F.col("y").alias("b"))
    return nodes.select(F.col("k").alias("a"), F.col("u").alias("b")).union(strong).union(weak)


def match_cascade(left: DataFrame, right: DataFrame, key: str, other: str, address: str, name: str, area: list[str], cutoff: float = 0.85) -> DataFrame:
    """JN17: (key, other, match_type): 0 equal address, 1 equal name, 2 names of a block ratio over cutoff (0 or more) within the area, 3 the only candidate of the area.

    Different names are compared once, whatever their areas.
    """
    from ..functions.text import address_key
    from .joins import first_of, only_candidate

    a = left.select(key, address_key(address).alias("_ad"), plain_upper(name).alias("_na"), *area)
    b = right.select(other, address_key(address).alias("_ad"), plain_upper(name).alias("_na"), *area)
    by = lambda c: a.where(f"{c} != ''").join(b.where(f"{c} != ''"), c).select(key, other)
    names = a.select("_na").union(b.select("_na")).where("_na != ''").distinct().select(F.col("_na").alias("k"), F.col("_na").alias("t"))
    alike = sequence_join(names, cutoff, both_ways=True).select(F.col("a").alias("_na"), F.col("b").alias("_nb"))
    near = a.join(alike, "_na").join(b.withColumnRenamed("_na", "_nb"), [*area, "_nb"]).select(key, other)
    return first_of([by("_ad"), by("_na"), near, only_candidate(a, b, key, other, area)], key, other)
