"""Divergence of sources: how far the word shares of a language's sources lie apart.

A language's table of counts, sources by terms, is cut into tiles of terms and
blocks of sources. A task gets one tile for a pair of blocks and builds a K2
quadtree over each block: a node is a rectangle of the table and is either all
zero or split into four. The trees of two blocks are walked together. Where both
are zero, all their pairs of sources cost the same for each term, the distance
of the sources' shares of a count of zero, so the rectangle is priced at once;
where either holds counts, the walk goes on down to leaves. Pairs' sums over tiles are added up by
Spark. All arithmetic is on whole numbers.

A share is p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)): V terms are kept in
the language, N is their number of occurrences in the source (or language).

Nulls and edge cases: null text, lang and source are empty strings. Terms are
runs of ASCII letters and characters beyond ASCII; only A-Z are lower-cased. A
language without kept terms has pairs of value 0 and no term rows; a language
with one source has no pairs. Repeated rows count each. Equal values rank by the
item's UTF-8 bytes. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, slices

MIN_DOCS, TOP, SCALE, PRIOR = 30, 50, 1_000_000_000, 5
#: Terms of a tile and sources of a block, about: what a task holds at once is two blocks of one tile.
TILE, SOURCES = 2048, 128
#: A rectangle of a quadtree is a leaf from here on.
LEAF_ROWS, LEAF_TERMS = 8, 32
#: Different terms that a task counts before it passes counts on.
HELD = 300_000

_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and df (documents); counts of a term may lie in several rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, tuple[Counter, Counter]] = {}

        def rows() -> pa.RecordBatch:
            out = [(*k, t.decode("utf-8", "replace"), c, df[t]) for k, (n, df) in seen.items() for t, c in n.items()]
            seen.clear()
            kinds = {"lang": pa.string(), "source": pa.string(), "term": pa.string(), "n": pa.int64(), "df": pa.int64()}
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))

        for b in batches:
            for part in slices(b, 0):
                for text, lang, source in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    n, df = seen.setdefault((lang, source), (Counter(), Counter()))
                    found = terms(text)
                    n.update(found)
                    df.update(set(found))
                if sum(len(n) for n, _ in seen.values()) > HELD:
                    yield rows()
        if seen:
            yield rows()

    return docs.select("text", *(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).mapInArrow(count, "lang string, source string, term string, n long, df long")


def share(n: str, total: str) -> str:
    """SQL for a share of SCALE, in steps of a thousand so that no product of a count passes 64 bits."""
    whole, rest = f"({n}) div ({total})", f"({n}) % ({total})"
    a, b = f"(1000L * ({rest})) div ({total})", f"(1000L * ({rest})) % ({total})"
    c, d = f"(1000L * ({b})) div ({total})", f"(1000L * ({b})) % ({total})"
    return f"1L + {SCALE}L * ({whole}) + 1000000L * ({a}) + 1000L * ({c}) + (1000L * ({d})) div ({total})"


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, n and held (source, n of those that have it) of the terms in at least min_docs documents of lang."""
    counts = term_counts(docs).repartition("lang", "term")  # both sums below need no further shuffle
    held = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    terms = held.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("held"))
    return terms.where(F.col("df") >= min_docs).drop("df")


def totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total and lang_total (the shares' denominators), tiles and blocks of each group that occurs."""
    groups = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    own = kept.select("lang", F.explode("held").alias("h")).groupBy("lang", F.col("h.source").alias("source")).agg(F.sum("h.n").alias("own_n"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count("*").alias("v"))
    blocks = groups.groupBy("lang").agg(F.expr(f"cast(ceil(count(*) / {SOURCES}) as int)").alias("blocks"))
    n, v = (lambda c: F.coalesce(c, F.lit(0))), F.coalesce("v", F.lit(0))
    return (
        groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").join(blocks, "lang")
        .select("lang", "source", F.greatest(n("own_n") + PRIOR * v, F.lit(1)).alias("total"), F.greatest(n("lang_n") + PRIOR * v, F.lit(1)).alias("lang_total"), F.expr(f"cast(ceil(coalesce(v, 0) / {TILE}) as int)").alias("tiles"), "blocks")
    )


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """As share(), of arrays."""
    out, rest = np.divmod(n, total)
    for _ in range(3):
        more, rest = np.divmod(1000 * rest, total)
        out = 1000 * out + more
    return 1 + out


class Quadtree:
    """K2 quadtree of one block of a tile: which rectangles hold counts at all, and the shares of the leaves that do."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, totals: np.ndarray, n_cols: int) -> None:
        self.totals, self.n_cols, self.n_rows = totals, n_cols, len(totals)
        self.zero = shares(np.full(len(totals), PRIOR, np.int64), totals)
        self.leaves: dict[tuple, np.ndarray] = {}
        self.filled: set[tuple] = set()
        self._grow(0, self.n_rows, 0, n_cols, rows, cols, shares(counts + PRIOR, totals[rows]))

    def _grow(self, r0, r1, c0, c1, rows, cols, values) -> None:
        if not len(rows):
            return
        self.filled.add((r0, r1, c0, c1))
        if is_leaf(r0, r1, c0, c1):
            block = np.repeat(self.zero[r0:r1, None], c1 - c0, 1)
            block[rows - r0, cols - c0] = values
            self.leaves[r0, r1, c0, c1] = block
            return
        for a, b in halves(r0, r1, LEAF_ROWS):
            for c, d in halves(c0, c1, LEAF_TERMS):
                own = (rows >= a) & (rows < b) & (cols >= c) & (cols < d)
                self._grow(a, b, c, d, rows[own], cols[own], values[own])

    def block(self, r0, r1, c0, c1) -> np.ndarray:
        found = self.leaves.get((r0, r1, c0, c1))
        return np.repeat(self.zero[r0:r1, None], c1 - c0, 1) if found is None else found


def is_leaf(r0: int, r1: int, c0: int, c1: int) -> bool:
    return r1 - r0 <= LEAF_ROWS and c1 - c0 <= LEAF_TERMS


def halves(a: int, b: int, least: int) -> list[tuple[int, int]]:
    return [(a, b)] if b - a <= least else [(a, (a + b) // 2), ((a + b) // 2, b)]


def pair_sums(x: Quadtree, y: Quadtree, same: bool) -> np.ndarray:
    """Sums of abs(p - q) over the tile's terms, for each source of x (rows) and of y; of one block with itself, only pairs of which the first comes earlier are right."""
    out = np.zeros((x.n_rows, y.n_rows), np.int64)
    todo = [(0, x.n_rows, 0, y.n_rows, 0, x.n_cols)] if x.n_rows and y.n_rows and x.n_cols else []
    while todo:
        a, b, c, d, e, f = todo.pop()
        if (a, b, e, f) not in x.filled and (c, d, e, f) not in y.filled:
            out[a:b, c:d] += (f - e) * np.abs(x.zero[a:b, None] - y.zero[None, c:d])
        elif is_leaf(a, b, e, f) and is_leaf(c, d, e, f):
            out[a:b, c:d] += np.abs(x.block(a, b, e, f)[:, None, :] - y.block(c, d, e, f)[None, :, :]).sum(2)
        else:
            for r in halves(a, b, LEAF_ROWS):
                for s in halves(c, d, LEAF_ROWS):
                    if not (same and s[1] <= r[0]):  # the pair the other way round
                        todo += [(*r, *s, *t) for t in halves(e, f, LEAF_TERMS)]
    return out


def _tile(key, table):
    """Sums of one tile for a pair of blocks: rows with a null array name the blocks' sources, the others are terms."""
    lang, _, i, j = (k.as_py() for k in key)
    heads = table.filter(pa.compute.is_null(table.column("held")))
    trees, names = {}, {}
    held = table.filter(pa.compute.is_valid(table.column("held"))).column("held").combine_chunks()
    held = held if isinstance(held, pa.Array) else pa.concat_arrays(held.chunks)
    lengths = np.diff(held.offsets.to_numpy()) if len(held) else np.empty(0, np.int64)
    flat = held.flatten()
    entry_col = np.repeat(np.argsort(np.argsort(-lengths, kind="stable")), lengths)  # widespread terms first, so that counts lie together
    entry_name, entry_n = flat.field("source").to_pylist(), flat.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
    for block in {i, j}:
        own = heads.filter(pa.compute.equal(heads.column("block"), block))
        total = dict(zip(own.column("source").to_pylist(), own.column("total").to_pylist(), strict=True))
        names[block] = sorted(total, key=lambda s: (-total[s], s))
        at = {s: k for k, s in enumerate(names[block])}
        rows = np.array([at.get(s, -1) for s in entry_name], np.int64)
        mine = rows >= 0
        trees[block] = Quadtree(rows[mine], entry_col[mine], entry_n[mine], np.array([total[s] for s in names[block]], np.int64), len(lengths))
    sums = pair_sums(trees[i], trees[j], i == j)
    a, b = np.triu_indices(len(names[i]), 1) if i == j else (x.ravel() for x in np.indices(sums.shape))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": pa.array([names[i][k] for k in a], pa.string()), "item": pa.array([names[j][k] for k in b], pa.string()), "value": pa.array(sums[a, b], pa.int64())})


def pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item and value of every pair of sources of a language, both ways."""
    langs = groups.groupBy("lang").agg(F.greatest(F.max("tiles"), F.lit(1)).alias("tiles"), F.max("blocks").alias("blocks"))
    block = "cast(pmod(xxhash64({}), blocks) as int)"
    with_all = "explode(transform(sequence(0, blocks - 1), o -> struct(least(o, {0}) as i, greatest(o, {0}) as j)))"
    cells = kept.join(langs, "lang").withColumn("tile", F.expr("cast(pmod(xxhash64(term), tiles) as int)"))
    cells = cells.withColumn("p", F.expr(f"explode(array_distinct(flatten(transform(held, h -> transform(sequence(0, blocks - 1), o -> struct(least(o, {block.format('h.source')}) as i, greatest(o, {block.format('h.source')}) as j))))))"))
    cells = cells.select("lang", "tile", "p.i", "p.j", F.expr(f"filter(held, h -> {block.format('h.source')} in (p.i, p.j))").alias("held"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("total"), F.lit(None).cast("int").alias("block"))
    heads = groups.drop("tiles", "blocks").join(langs, "lang").withColumn("block", F.expr(block.format("source"))).withColumn("p", F.expr(with_all.format("block")))
    heads = heads.withColumn("tile", F.expr("explode(sequence(0, tiles - 1))")).select("lang", "tile", "p.i", "p.j", F.lit(None).cast(cells.schema["held"].dataType).alias("held"), "source", "total", "block")
    sums = cells.unionByName(heads).groupBy("lang", "tile", "i", "j").applyInArrow(_tile, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return sums.select("lang", "value", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x")).select("lang", "x.source", "x.item", "value")


def over_used(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item and value of the terms whose share in a source is above that in its language."""
    held = kept.select("lang", "term", F.col("n").alias("lang_n"), F.explode("held").alias("h")).select("lang", "h.source", "term", "lang_n", "h.n")
    both = held.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
    both = both.select("lang", "source", F.col("term").alias("item"), F.expr(f"({share(f'n + {PRIOR}', 'total')}) - ({share(f'lang_n + {PRIOR}', 'lang_total')})").alias("value"))
    return both.where("value > 0")


def audit(docs: DataFrame, *, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: part pair has the distance of each other source of the language, part term the top terms of each source above its language."""
    kept = materialise(kept_terms(docs, min_docs), "audit-terms")
    groups = materialise(totals(docs, kept), "audit-groups")
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    ranked = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank) for part, df in (("pair", pairs(kept, groups)), ("term", over_used(kept, groups)))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))
