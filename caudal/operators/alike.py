"""Similarity joins of short texts, and the greedy grouping that rests on them.

At thresholds of 60 to 85 percent no index of letters or segments leaves much out
of names of some thirty letters: two names of unrelated words share most of their
letters, and pieces that must survive are one or two letters long. So texts are
ranked by length and cut into blocks of BLOCK; a pair of blocks whose lengths
allow the similarity is one group of a task, which bounds all its pairs at once
by arrays (lengths, letter counts, shared words) and then computes the exact
score of those that are left by bit-parallel arrays. Only pairs that reach the
threshold leave a task, no key is hot as blocks are of equal size, and a text
travels once for each block that it is held against.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import cut, drop
from .spatial import connected
from .windows import global_ids

BLOCK = 512
#: Pairs that one array step takes at once.
STEP = 1 << 16


# --- arrays ------------------------------------------------------------------


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all letters of some texts the code point, the number of the text and the place in it; and the texts' lengths."""
    sizes = np.array(list(map(len, texts)), np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.repeat(np.arange(len(texts)), sizes), np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes), sizes


def subsequences(left: list[str], right: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of left[i] and right[j], for all pairs at once by bit vectors."""
    out = np.zeros(len(i), np.int64)
    if not len(i):
        return out
    (used, i), (other, j) = (np.unique(x, return_inverse=True) for x in (i, j))
    left, right = [left[k] for k in used], [right[k] for k in other]
    (codes, of, at, _), (others, row, place, sizes) = _letters(left), _letters(right)
    known, width = np.unique(codes), max(1, -(-max(map(len, left)) // 64))
    none = len(known)
    where = np.zeros((len(left), none + 1, width), np.uint64)
    np.bitwise_or.at(where, (of, np.searchsorted(known, codes), at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    letters = np.full((len(right), max(1, sizes.max(initial=0))), none, np.int32)
    if none:
        found = np.minimum(np.searchsorted(known, others), none - 1)
        letters[row, place] = np.where(known[found] == others, found, none)
    for a in range(0, len(i), STEP):
        x, y = i[a : a + STEP], j[a : a + STEP]
        state = [np.full(len(x), ~np.uint64(0)) for _ in range(width)]
        for at in range(int(sizes[y].max(initial=0))):
            masks, carry = where[x, letters[y, at]], None
            for w in range(width):
                hit = state[w] & masks[:, w]
                total = state[w] + hit
                if width > 1:
                    over = total < hit
                    if carry is not None:
                        total = total + carry
                        over |= total < carry
                    carry = over.astype(np.uint64)
                state[w] = total | (state[w] - hit)
        out[a : a + STEP] = sum(np.bitwise_count(~s).astype(np.int64) for s in state)
    return out


class Block:
    """Texts with what bounds need of them: lengths, word sets, letter counts."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        self.sets = [frozenset(t.split()) for t in texts]
        self.words = [" ".join(sorted(s)) for s in self.sets]
        self.n, self.n_words, self.n_set = (np.array(list(map(len, x)), np.int64) for x in (texts, self.words, self.sets))


def counts(texts: list[str], letters: np.ndarray, kind: type) -> np.ndarray:
    """How often each text has each of some sorted letters (code points)."""
    codes, of, _, _ = _letters(texts)
    at = np.searchsorted(letters, codes)
    known = letters[np.minimum(at, len(letters) - 1)] == codes
    return np.bincount((at * len(texts) + of)[known], minlength=len(letters) * len(texts)).reshape(len(letters), len(texts)).astype(kind)


def in_common(ta: list[str], tb: list[str]) -> np.ndarray:
    """Letters that each pair of texts has in common, as multisets: never under the longest common subsequence."""
    longest = max(map(len, (*ta, *tb)), default=0)
    kind = np.uint8 if longest < 1 << 8 else np.uint16 if longest < 1 << 16 else np.uint32  # the narrower, the faster
    letters = np.intersect1d(_letters(ta)[0], _letters(tb)[0])
    out = np.zeros((len(ta), len(tb)), kind)
    if len(letters):
        for x, y in zip(counts(ta, letters, kind), counts(tb, letters, kind), strict=True):
            out += np.minimum.outer(x, y)
    return out


def shared_words(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair the number of shared words, the length of these joined by blanks, and a hash of their set."""
    at: dict[str, tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))
    for side, block in enumerate((a, b)):
        for k, s in enumerate(block.sets):
            for w in s:
                at[w][side].append(k)
    n, size = (np.zeros((len(a.texts), len(b.texts)), np.int32) for _ in range(2))
    name = np.zeros((len(a.texts), len(b.texts)), np.uint64)
    for w, (x, y) in at.items():
        if x and y:
            ix = np.ix_(x, y) if len(x) < len(a.texts) or len(y) < len(b.texts) else (slice(None), slice(None))
            n[ix] += 1
            size[ix] += len(w) + 1
            name[ix] += np.uint64(hash(w) & (2**64 - 1))
    return n, np.maximum(size - 1, 0), name


def _percent(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    return 200.0 * c / np.maximum(n, 1)


def similar(a: Block, b: Block, least: float | np.ndarray, same: bool, shared: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j) of a and b whose similarity (fuzzy.similarity) is at least least (a number, or one for each pair), and the similarity; of one block with itself those with i < j."""
    common = in_common(a.texts, b.texts)
    # The word sets give 60 at most, so the letters must give the rest; all else is looked at for the pairs that are left.
    i, j = np.nonzero(common >= (least - 60.0) / 80.0 * (a.n[:, None] + b.n[None, :]) - 1e-6)
    keep = (i < j if same else True) & (a.n[i] > 0) & (b.n[j] > 0)
    i, j = i[keep], j[keep]
    if not len(i):
        return i, j, np.zeros(0)
    least = np.broadcast_to(least, common.shape)[i, j]
    n, size, name = (x[i, j] for x in shared_words(a, b))
    length, words = a.n[i] + b.n[j], a.n_words[i] + b.n_words[j]
    some = (a.n_set[i] > 0) & (b.n_set[j] > 0)
    within = some & (n > 0) & ((n == a.n_set[i]) | (n == b.n_set[j]))
    alone = np.where(n > 0, np.maximum(_percent(size, size + a.n_words[i]), _percent(size, size + b.n_words[j])), 0.0)
    bound = np.where(within, 100.0, np.where(some, np.maximum(alone, _percent(in_common(a.words, b.words)[i, j], words)), 0.0))
    left = (0.4 * _percent(common[i, j], length) + 0.6 * bound >= least - 1e-9) & (n >= shared)
    i, j, least, size, name, length, words, some, within, alone, bound = (x[left] for x in (i, j, least, size, name, length, words, some, within, alone, bound))
    first = _percent(subsequences(a.texts, b.texts, i, j), length)
    left = 0.4 * first + 0.6 * bound >= least - 1e-9
    i, j, least, size, name, words, some, within, alone, first = (x[left] for x in (i, j, least, size, name, words, some, within, alone, first))
    second = np.where(within, 100.0, np.where(some, alone, 0.0))
    open_ = np.flatnonzero(some & ~within)
    # The other words of a text, by the set of shared ones: a pair's common part leads both texts, so only the rest is left to compare.
    x, y, shares = i[open_], j[open_], np.unique(name[open_], return_inverse=True)[1]
    rests = []
    for me, mine, other, others in ((x, a.sets, y, b.sets), (y, b.sets, x, a.sets)):
        _, where, at = np.unique(me * (len(open_) + 1) + shares, return_index=True, return_inverse=True)
        rests.append(([" ".join(sorted(mine[me[k]] - others[other[k]])) for k in where], at))
    found = subsequences(*(t for t, _ in rests), *(at for _, at in rests))
    both = size[open_]
    second[open_] = np.maximum(second[open_], _percent(found + both + (both > 0), words[open_]))
    score = 0.4 * first + 0.6 * second
    keep = score >= least
    return i[keep], j[keep], score[keep]


def of_ratio(a: Block, b: Block, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) whose ratio (fuzzy.ratio) is at least least."""
    length = a.n[:, None] + b.n[None, :]
    ok = _percent(in_common(a.texts, b.texts), length) >= least - 1e-9
    i, j = np.nonzero(np.triu(ok, 1) if same else ok)
    keep = _percent(subsequences(a.texts, b.texts, i, j), length[i, j]) >= least - 1e-9
    return i[keep], j[keep]


# --- joins -------------------------------------------------------------------


def block_join(texts: DataFrame, longest: Callable[[int], float], score: Callable, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b, similarity) of the keys of texts (k, t), as score(block, block, same) gives them: arrays i, j and similarities.

    longest: how long a text may be that pairs with one of n letters, as long or
    shorter. A row for each block reaches the driver, for its range of lengths.
    """
    kind = texts.schema["k"].dataType.simpleString()
    ranked = global_ids(texts.withColumn("n", F.length("t")), ["n", "t", "k"], "_at").withColumn("block", F.floor((F.col("_at") - 1) / block).cast("long")).drop("_at")
    ranked = cut(ranked, "blocks")
    edges = ranked.groupBy("block").agg(F.min("n"), F.max("n")).orderBy("block").collect()
    shortest = np.array([r[1] for r in edges])
    last = [int(np.searchsorted(shortest, longest(r[2]), "right")) - 1 for r in edges]
    first = [int(np.searchsorted(last, k)) for k in range(len(edges))]  # last grows with the length
    ranges = texts.sparkSession.createDataFrame([(k, a, b) for k, (a, b) in enumerate(zip(first, last, strict=True))], "block long, first long, last long")

    def run(key, table):
        i, j = (x.as_py() for x in key)
        of = {b: table.filter(pc.equal(table.column("block"), b)).sort_by("k") for b in {i, j}}
        blocks = {b: Block(t.column("t").to_pylist()) for b, t in of.items()}
        x, y, s = score(blocks[i], blocks[j], i == j)
        a, b = (of[k].column("k").take(pa.array(v)) for k, v in ((i, x), (j, y)))
        return pa.table([a.combine_chunks(), b.combine_chunks(), pa.array(s, pa.float64())], names=["a", "b", "similarity"])

    dealt = ranked.join(ranges, "block").select("block", "k", "t", F.explode(F.sequence("first", "last")).alias("o"))
    dealt = dealt.select(F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "k", "t")
    return dealt.groupBy("i", "j").applyInArrow(run, f"a {kind}, b {kind}, similarity double")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")


def ratio_bound(least: float) -> Callable[[int], float]:
    """How long a text may be whose ratio with one of n letters is least or more."""
    return lambda n: math.inf if least <= 0 else n * (200.0 - least) / least + 1e-6


def similarity_join(texts: DataFrame, least: float, shared: int = 0, block: int = BLOCK) -> DataFrame:
    """(a, b, similarity), a < b, of all texts (k, t) of at least that similarity, whether or not they share a word."""
    # The word-set part gives 60 at most; the ratio must give the rest.
    return _ordered(block_join(texts, ratio_bound((least - 60.0) / 0.4), lambda a, b, same: similar(a, b, least, same, shared), block))


def sequence_join(texts: DataFrame, over: float, both_ways: bool = False, block: int = BLOCK) -> DataFrame:
    """(a, b, similarity) of all texts (k, t) whose block ratio (of 1) is over over: once with a < b, or for either order, as the ratio depends on it.

    Matching blocks are a common subsequence, so the arrays' exact ratio decides which pairs are looked at one by one.
    """

    def score(a: Block, b: Block, same: bool):
        i, j = of_ratio(a, b, 100.0 * over, same)
        return i, j, [0.0] * len(i)

    found = block_join(texts, ratio_bound(100.0 * over), score, block)
    pairs = _ordered(found).select("a", "b")
    if both_ways:
        pairs = pairs.union(pairs.select("b", "a"))
    pairs = pairs.join(texts.select(F.col("k").alias("a"), F.col("t").alias("ta")), "a").join(texts.select(F.col("k").alias("b"), F.col("t").alias("tb")), "b")

    @F.pandas_udf("double")
    def blocks(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y, strict=True)], dtype="float64")

    return pairs.select("a", "b", blocks("ta", "tb").alias("similarity")).where(F.col("similarity") > over)


# --- greedy grouping by similarity ---------------------------------------------

#: Rows that are settled at once: at first, and at most.
HEAD = (1 << 10, 1 << 14)


class Rows:
    """Names and addresses of rows, each different text once."""

    def __init__(self, table: pa.Table) -> None:
        (self.name, names), (self.place, places) = (pd.factorize(np.array(table.column(c).to_pylist(), object)) for c in ("name", "address"))
        self.names, self.places = Block(names.tolist()), Block(places.tolist())


def alike_rows(a: Rows, b: Rows, threshold: float) -> np.ndarray:
    """For each pair of rows whether their names are similar by threshold, or names and addresses by 0.7 of it."""
    names, near = (np.zeros((len(x.texts), len(y.texts)), bool) for x, y in ((a.names, b.names), (a.places, b.places)))
    i, j, _ = similar(a.places, b.places, 0.7 * threshold, False)
    least = threshold
    if placed := len(i) > 0:
        near[i, j] = True
        near = near[a.place[:, None], b.place]
        some, (i, j) = names.copy(), np.nonzero(near)
        some[a.name[i], b.name[j]] = True
        least = np.where(some, 0.7 * threshold, threshold)
    i, j, s = similar(a.names, b.names, least, False)
    strong = s >= threshold
    names[i[strong], j[strong]] = True
    out = names[a.name[:, None], b.name]
    if placed:
        names[i, j] = True
        out |= near & names[a.name[:, None], b.name]
    return out


def _settle_head(table: pa.Table) -> pa.Table:
    """Openers of a head's rows, in order. table: for blocks i <= j a bit for each pair of rows, and the keys of block i where i = j."""
    bits = {(r["i"], r["j"]): r["bits"] for r in table.select(["i", "j", "bits"]).to_pylist()}
    of = table.filter(pc.equal(table.column("i"), table.column("j"))).sort_by("i").column("keys").combine_chunks()
    keys, sizes = of.flatten(), of.value_lengths().to_numpy()
    starts = np.cumsum(sizes) - sizes
    group = np.full(len(keys), -1)
    for i, (start, size) in enumerate(zip(starts, sizes, strict=True)):
        linked = np.hstack([np.unpackbits(np.frombuffer(bits[i, j], np.uint8).reshape(size, -1), axis=1, count=sizes[j]) for j in range(i, len(sizes))]).astype(bool)
        later = group[start:]
        for r in range(size):
            if later[r] < 0:
                later[r] = start + r
                later[linked[r] & (later < 0)] = start + r
    opens = group == np.arange(len(group))
    return pa.table([keys, keys.take(pa.array(group)), pa.array(np.cumsum(opens) - 1, pa.int64(), mask=~opens)], names=["k", "opener", "nth"])


def greedy_alike(rows: DataFrame, threshold: float, head: tuple[int, int] = HEAD, block: int = BLOCK) -> DataFrame:
    """(k, opener) of the order-dependent grouping of rows (k, name, address) by similarity: by ascending k, a row that no group has taken opens one and takes all later ones that are alike (alike_rows).

    Only openers are held against all later rows. Each round settles the first rows
    that are left, head[0] at first and twice as many a round up to head[1]: a bit
    for each pair of them goes to one task, so that alike rows make no pairs. Then
    their openers take rows from the rest, by blocks; a row leaves a task with its
    first opener only. The driver gets a number for each head[0] rows of a head's
    range, at most head[1] a round, and counts.
    """
    kind = rows.schema["k"].dataType.simpleString()
    spark = rows.sparkSession
    rest = global_ids(rows.select("k", "name", "address"), ["k"], "at").withColumn("at", F.col("at") - 1)
    rest = cut(rest.withColumn("range", F.floor(F.col("at") / head[0])).withColumn("block", F.floor(F.col("at") / block)), "rest")
    blocks, end = rest.agg(F.max("block") + 1, F.max("range")).first()

    upto = lambda start, end: F.sequence(F.lit(start).cast("long"), F.lit(end - 1).cast("long"))

    def by_pair(dealt: DataFrame, pairs: int, run: Callable, schema: str) -> DataFrame:
        """run on each group (i, j). The number of tasks follows that of groups, as these are small and costly."""
        return dealt.repartition(min(2 * pairs, int(spark.conf.get("spark.sql.shuffle.partitions"))), "i", "j").groupBy("i", "j").applyInArrow(run, schema)

    def within(key, table):
        i, j = (x.as_py() for x in key)
        of = {b: table.filter(pc.equal(table.column("block"), b)).sort_by("at") for b in {i, j}}
        a, b = Rows(of[i]), Rows(of[j])
        linked = alike_rows(a, b, threshold)
        bits = np.packbits(np.triu(linked, 1) if i == j else linked, axis=1).tobytes()
        keys = of[i].column("k").combine_chunks()
        return pa.table([[i], [j], [bits], pa.array([keys.to_pylist() if i == j else None], pa.list_(keys.type))], names=["i", "j", "bits", "keys"])

    def taken(key, table):
        some, openers = (table.filter(pc.equal(table.column("opens"), x)) for x in (False, True))
        if not some.num_rows or not openers.num_rows:
            return pa.table([table.column("k").slice(0, 0)] * 2, names=["k", "opener"])
        openers = openers.sort_by("at")
        linked = alike_rows(Rows(some), Rows(openers), threshold)
        x = np.flatnonzero(linked.any(axis=1))
        return pa.table([some.column("k").take(pa.array(x)), openers.column("k").take(pa.array(linked[x].argmax(axis=1)))], names=["k", "opener"])

    out, size = rows.select("k", F.col("k").alias("opener")).limit(0), head[0]
    while ranges := rest.groupBy("range").count().orderBy("range").limit(size).collect():
        ends = np.cumsum([r["count"] for r in ranges])
        n = int(np.searchsorted(ends, size, "right"))
        last, n = ranges[n - 1]["range"], -(-int(ends[n - 1]) // block)
        first = rest.where(F.col("range") <= last).withColumn("at", F.row_number().over(W.orderBy("at")) - 1)
        first = cut(first.select("k", "name", "address", "at", F.floor(F.col("at") / block).alias("block")), "head")
        dealt = first.withColumn("o", F.explode(upto(0, n))).withColumns({"i": F.least("block", "o"), "j": F.greatest("block", "o")})
        tiles = by_pair(dealt, n * (n + 1) // 2, within, f"i long, j long, bits binary, keys array<{kind}>")
        settled = cut(tiles.groupBy().applyInArrow(_settle_head, f"k {kind}, opener {kind}, nth long"), "settled")
        out = out.union(settled.select("k", "opener"))
        if last == end:  # no rows are left
            break
        left = rest.where(F.col("range") > last)
        openers = settled.where("nth is not null").select("k", "nth")
        n, begin = -(-openers.count() // block), (last + 1) * head[0] // block
        dealt = left.select(F.lit(False).alias("opens"), F.col("block").alias("i"), F.explode(upto(0, n)).alias("j"), "k", "name", "address", "at")
        openers = openers.join(first, "k").withColumn("i", F.explode(upto(begin, blocks)))
        dealt = dealt.union(openers.select(F.lit(True), "i", F.floor(F.col("nth") / block), "k", "name", "address", "nth"))
        found = cut(by_pair(dealt, n * (blocks - begin), taken, f"k {kind}, opener {kind}").groupBy("k").agg(F.min("opener").alias("opener")), "taken")
        out = out.union(found)
        left = cut(left.join(found, "k", "left_anti"), "rest")
        drop(rest)
        drop(first)
        rest, size = left, min(2 * size, head[1])
    return out


# --- greedy grouping by given links ---------------------------------------------

#: Rows and links of a part of the graph that one task settles at most; larger parts are settled by rounds.
MOST = 200_000


def _settle(rows: pd.DataFrame) -> pd.DataFrame:
    """Openers of one part of the graph, in order. rows: kind (0 row and its name, 1 linked names, 2 linked rows), a, b."""
    of_kind = {k: g for k, g in rows.groupby("kind")}
    names, links = defaultdict(list), defaultdict(list)
    for k, to in ((1, names), (2, links)):
        if k in of_kind:
            for a, b in zip(of_kind[k]["a"], of_kind[k]["b"], strict=True):
                to[a].append(b)
                to[b].append(a)
    first: dict = {}  # of a name, its first row that opens a group
    opens: set = set()
    out = []
    for row, name in sorted(zip(of_kind[0]["a"], of_kind[0]["b"], strict=True)):
        near = [first[v] for v in (name, *names[name]) if v in first] + [r for r in links[row] if r in opens]
        group = min(near, default=row)
        if group == row:
            opens.add(row)
            first.setdefault(name, row)
        out.append((row, group))
    return pd.DataFrame(out, columns=["k", "opener"])


def greedy(rows: DataFrame, names: DataFrame, links: DataFrame, most: int = MOST) -> DataFrame:
    """(k, opener) of the order-dependent grouping: rows by ascending k; one that no group has taken opens a group and takes all later ones linked to it.

    rows: k and u, the name of a row, itself one of the keys; rows of a name are
    linked to each other. names: (a, b) names of which all rows are linked. links:
    (a, b) further linked rows. A row opens a group if no earlier linked row does, so
    each connected part of the graph can be settled alone: a part of up to most
    rows and links by a task, a larger one by rounds, in which a row opens a
    group once all earlier linked rows are settled.
    """
    kind = rows.schema["k"].dataType.simpleString()
    rows, names, links = cut(rows.select("k", "u"), "rows"), cut(names.select("a", "b"), "names"), cut(links.select("a", "b"), "row-links")
    every = rows.select(F.lit(0).alias("kind"), F.col("k").alias("a"), F.col("u").alias("b"))
    every = every.union(names.select(F.lit(1), "a", "b")).union(links.select(F.lit(2), "a", "b"))
    if every.count() <= most:
        return every.withColumn("comp", F.lit(0)).groupBy("comp").applyInPandas(lambda g: _settle(g), f"k {kind}, opener {kind}")
    parts = cut(every.join(connected(every.select("a", "b")).withColumnRenamed("node", "a"), "a").select("kind", "a", "b", "comp"), "parts")
    sizes = parts.groupBy("comp").agg(F.count("*").alias("size"))
    small = parts.join(sizes.where(F.col("size") <= most), "comp").groupBy("comp").applyInPandas(lambda g: _settle(g), f"k {kind}, opener {kind}")
    large = parts.join(sizes.where(F.col("size") > most), "comp")
    of = lambda k, *to: large.where(F.col("kind") == k).select(*(F.col(c).alias(t) for c, t in zip("ab", to, strict=True)))
    return small.union(_by_rounds(of(0, "k", "u"), of(1, "a", "b"), of(2, "a", "b")))


def _by_rounds(rows: DataFrame, names: DataFrame, links: DataFrame) -> DataFrame:
    """As greedy(), for one graph of any size: each round settles all rows whose earlier linked rows are settled; one number a round reaches the driver."""
    both = names.union(names.select("b", "a")).union(rows.select(F.col("u").alias("a"), F.col("u").alias("b"))).distinct()  # every name is linked to itself
    both, links = cut(both, "names"), cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "row-links")

    def near(of: DataFrame, some: DataFrame) -> DataFrame:
        """of (k, u) with by_name and by_link: the earliest of some (k, u) that is linked to a row by its name, and the earliest before it that is linked to itself."""
        by_name = both.join(some.groupBy(F.col("u").alias("b")).agg(F.min("k").alias("m")), "b").groupBy(F.col("a").alias("u")).agg(F.min("m").alias("by_name"))
        by_link = links.join(some.select(F.col("k").alias("a")), "a").groupBy(F.col("b").alias("k")).agg(F.min("a").alias("by_link"))
        return of.join(by_name, "u", "left").join(by_link, "k", "left")

    open_ = cut(rows, "open")
    openers = None
    while open_.limit(1).count():
        new = near(open_, open_).where((F.col("by_name") == F.col("k")) & F.col("by_link").isNull()).select("k", "u")
        new = cut(new, "openers")
        taken = near(open_, new).where((F.col("by_name") <= F.col("k")) | F.col("by_link").isNotNull()).select("k")
        rest = cut(open_.join(taken, "k", "left_anti"), "open")
        drop(open_)
        open_, openers = rest, new if openers is None else openers.union(new)
    if openers is None:
        return rows.select("k", F.col("k").alias("opener"))
    return near(rows, openers).select("k", F.least("by_name", "by_link").alias("opener"))
