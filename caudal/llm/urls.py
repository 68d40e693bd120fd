"""URL filters: rules first, then a ratio of character language models.

A rule names a host, a path prefix and a verdict; it fits the host and all its
subdomains, and the longest fitting rule decides. For all other URLs two
variable-order Markov models of characters, one of accepted and one of rejected
URLs, give the difference of log-likelihoods by character; beyond a calibrated
threshold a URL is blocked.

A model keeps the exact counts of characters after contexts of up to ORDER bytes.
Contexts are of variable order: one stays if it is at least 1 / CONTEXTS of its
side's characters, so each order has CONTEXTS of them at most, however large the
table; where a longer context is not kept, the next shorter one speaks. Each kept
context's estimate is drawn to that of the context one shorter by STRENGTH
imagined counts, down to the uniform one, so the probabilities of the characters
after any context sum to one.

The models learn from all URLs of the table that rules decide, one fifth (by
hash) left out to calibrate the threshold: all of it is scored, in steps of STEP,
and the threshold is the one that separates best among those that block at most
MOST_FALSE of the accepted URLs.

Nulls and edge cases: a null URL, or one without ://, has an empty host and path
and fits no rule; a null or empty URL is allowed, as nothing speaks against it.
If rules accept none or reject none of the table's URLs, the rest is allowed.
Repeated rows are judged each. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, discard, lower_ascii, materialise, slices

ORDER, STRENGTH, CONTEXTS = 4, 4.0, 1 << 14
STEP, MOST_FALSE = 1e-3, 0.01
#: (verdict, host, path prefix) of the query's contract.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def deciding_rule(host: Column, path: Column, rules) -> Column:
    """struct(size, rule, verdict) of the longest rule that fits, else null."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    known = F.array(*(F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")).alias("rule")) for v, h, p in rules))
    fits = F.filter(known, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"]))
    return F.array_max(F.transform(fits, lambda r: r["rule"]))


def _keys(urls: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order a number that is exact for order, context and character (the last byte), for all bytes and the end of all URLs; and where each URL starts."""
    raw = [u.encode("utf-8", "surrogatepass") for u in urls]
    a = np.frombuffer(b"".join(b"\0" * ORDER + r + b"\1" for r in raw), np.uint8).astype(np.int64)
    lengths = np.array([len(r) + 1 for r in raw])
    starts = np.cumsum(lengths) - lengths
    pos = np.arange(lengths.sum()) + np.repeat((np.arange(len(raw)) + 1) * ORDER, lengths)
    keys, context = [], np.zeros(len(pos), np.int64)
    for k in range(ORDER + 1):
        if k:
            context = context | (a[pos - k] << (8 * k))
        keys.append((k << 8 * (ORDER + 1)) | context | a[pos])
    return keys, starts


def _count(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The counts of keys in a table of sorted keys and their counts; 0 where they are missing."""
    known, n = table
    if not len(known):
        return np.zeros(len(keys))
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, n[at], 0.0)


@dataclass
class Model:
    grams: list  # of accepted and rejected URLs: sorted keys, counts
    contexts: list
    threshold: float

    def log_p(self, side: int, urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each byte and end under the model of that side, and where each URL starts."""
        keys, starts = _keys(urls)
        p = np.full(len(keys[0]), 1 / 256)
        for key in keys:
            n = _count(self.contexts[side], key >> 8)
            p = np.where(n > 0, (_count(self.grams[side], key) + STRENGTH * p) / (n + STRENGTH), p)
        return np.log(p), starts

    def ratio(self, urls: list[str]) -> np.ndarray:
        """Log-likelihood of each URL as a rejected one less that as an accepted one, by character."""
        good, starts = self.log_p(0, urls)
        bad, _ = self.log_p(1, urls)
        return np.add.reduceat(bad - good, starts) / np.diff(np.append(starts, len(good)))


SIDES = ("allow", "block")


def _gram_counts(decided: DataFrame) -> DataFrame:
    """(side, key, n) over all URLs of (url, verdict)."""

    def count(batches):
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]

        def rows(side: int):
            keys, n = (np.concatenate(x) for x in zip(*held[side], strict=True))
            held[side].clear()
            kinds, at = np.unique(keys, return_inverse=True)
            return kinds, np.bincount(at, n).astype(np.int64)

        def batch(side: int, kinds: np.ndarray, n: np.ndarray):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(kinds), side, np.int32)), pa.array(kinds), pa.array(n)], names=["side", "key", "n"])

        for b in batches:
            for part in slices(b, 0):
                urls, verdicts = part.column(0).to_pylist(), part.column(1).to_pylist()
                for side, v in enumerate(SIDES):
                    own = [u for u, w in zip(urls, verdicts, strict=True) if w == v]
                    if own:
                        held[side].append(np.unique(np.concatenate(_keys(own)[0]), return_counts=True))
                    if sum(len(k) for k, _ in held[side]) > 1_000_000:
                        kinds, n = rows(side)
                        if len(kinds) > 500_000:
                            yield batch(side, kinds, n)
                        else:
                            held[side].append((kinds, n))
        for side in (0, 1):
            if held[side]:
                yield batch(side, *rows(side))

    return decided.select("url", "verdict").mapInArrow(count, "side int, key long, n long").groupBy("side", "key").agg(F.sum("n").alias("n"))


def _threshold(model: Model, held: DataFrame) -> float:
    """Of the URLs left out: the threshold that separates best; 0 if a side is missing."""

    def bins(batches):
        for b in batches:
            for part in slices(b, 0):
                at = np.floor(model.ratio(part.column(0).to_pylist()) / STEP).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(at)], names=["verdict", "bin"])

    got = held.select("url", "verdict").mapInArrow(bins, "verdict string, bin long").groupBy("verdict", "bin").count().collect()
    at = np.unique([r.bin for r in got]) if got else np.zeros(0)
    n = np.zeros((2, len(at)))
    for r in got:
        n[SIDES.index(r.verdict), np.searchsorted(at, r.bin)] += r["count"]
    if not len(at) or not n.sum(1).all():
        return 0.0
    false, caught = 1 - np.cumsum(n, 1) / n.sum(1, keepdims=True)
    best = int(np.where(false <= MOST_FALSE, caught - false, -1).argmax())
    return float((at[best] + 1 + (at[best + 1] if best + 1 < len(at) else at[best] + 1)) / 2 * STEP)  # halfway to the next URL


def train(decided: DataFrame) -> Model | None:
    """From (url, verdict) rows that rules decide; None if one of the verdicts is missing."""
    kept = decided.where(F.col("url").isNotNull() & (F.length("url") > 0)).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(5)))
    counts = materialise(_gram_counts(kept.where("fold != 0")), "grams")
    context = F.shiftright("key", 8).alias("context")
    totals = counts.groupBy("side", context).agg(F.sum("n").alias("total"))
    mass = {r.side: r.total for r in totals.where("context = 0").collect()}
    if len(mass) < 2:
        discard(counts)
        return None
    least = F.when(F.col("side") == 0, mass[0] / CONTEXTS).otherwise(mass[1] / CONTEXTS)
    known = counts.withColumn("context", context).join(totals.where(F.col("total") >= least), ["side", "context"]).select("side", "key", "n").toArrow()
    discard(counts)
    side, key, n = (known.column(c).to_numpy() for c in ("side", "key", "n"))
    model = Model([], [], np.inf)
    for s in (0, 1):
        order = np.argsort(key[side == s])
        # The side with more URLs counts less, else anything new would look like the other side.
        k, c = key[side == s][order], n[side == s][order] * (min(mass.values()) / mass[s])
        model.grams.append((k, c))
        first = np.flatnonzero(np.append(True, (k[1:] >> 8) != (k[:-1] >> 8)))
        model.contexts.append((k[first] >> 8, np.add.reduceat(c, first)))
    model.threshold = _threshold(model, kept.where("fold = 0"))
    return model


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score (null where nothing was learned) for each row of pages (page_id, url)."""
    own = pages.select("page_id", "url")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    ruled = own.select("page_id", "url", host.alias("host"), path.alias("path"), deciding_rule(host, path, rules).alias("by"))
    model = train(ruled.where(F.col("by").isNotNull()).select("url", F.col("by.verdict").alias("verdict")))
    if model is None:
        return ruled.select("page_id", "host", "path", F.col("by.rule").alias("rule"), F.coalesce("by.verdict", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))

    def run(texts: list) -> list[pa.Array]:
        at = [i for i, t in enumerate(texts) if t]
        out: list = [None] * len(texts)
        if at:
            for i, x in zip(at, model.ratio([texts[i] for i in at]).tolist(), strict=True):
                out[i] = x
        return [pa.array(out, pa.float64())]

    scored, (score,) = annotate(ruled.select("page_id", "url", "host", "path", F.col("by.rule").alias("rule"), F.col("by.verdict").alias("verdict")), "url", run, [T.StructField("score", T.DoubleType())])
    blocked = F.coalesce(F.col(score) > model.threshold, F.lit(False))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"), F.col(score).alias("score"))
