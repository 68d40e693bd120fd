"""Interaction of filters: what each removes, in every order, alone or after others.

One pass over the texts gives each document a mask of the filters that it fails
but for E, and 128 bits of hash of its text. A counting Bloom filter over the
hashes, summed from the tasks' partial counts, clears texts that no other
document can have. Only the texts of the others travel, each once a task, to
find the smallest id of each text, grouped by the text itself. The masks are then counted
by part and label; every figure of every order is a sum over these at most 32
counts a part, so that orders cost nothing in documents.

Filters: A under 200 words; B 100 * distinct words < 50 * words; C 100 * [A-Z]
characters > 2 * code points; D holds any of #$%&*|; E equal to the text of a
smaller doc_id anywhere in the table.

Nulls and edge cases: a null text is the empty text, a null source the empty
part. A null doc_id is no smaller id and has none, so such a row never fails E
and fails no other; it has no labels. Rows that share an id are each counted,
and fail E only where a smaller id has their text. A document is good, or toxic,
if any row of labels with its id says so. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise, slices

FILTERS = "ABCDE"
ALL = 1 << len(FILTERS)
MARKS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
#: Slots of the counting Bloom filter: 16 for each document, but at most 2 ** 28. What travels to tasks is a bit for each slot, so 32 MB at most; beyond, the filter only clears fewer texts.
LEAST_BITS, MOST_BITS, PROBES = 16, 28, 3


def fails(text: str | None) -> int:
    """The mask of A to D: bit k for filter k."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    return (
        (len(words) < 200)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * (len(raw) - len(raw.translate(None, CAPITALS))) > 2 * len(text or "")) << 2
        | (len(raw) != len(raw.translate(None, MARKS))) << 3
    )


def _hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest((t or "").encode("utf-8", "surrogatepass")) for t in texts), "<i8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _slots(h1: np.ndarray, h2: np.ndarray, bits: int) -> list[np.ndarray]:
    """The filter's slots of texts: double hashing, PROBES slots each."""
    low = np.int64((1 << bits) - 1)
    return [((h1 & low) + np.int64(i) * (h2 & low)) & low for i in range(PROBES)]


def masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (of A to D), h1, h2 and n, the number of rows alike in all these. docs: doc_id, text, source."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 1):
                texts = part.column(1).to_pylist()
                h1, h2 = _hashes(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([fails(t) for t in texts], pa.int32()), pa.array(h1), pa.array(h2)], names=["doc_id", "part", "mask", "h1", "h2"])

    picked = docs.select("doc_id", "text", F.coalesce("source", F.lit("")).alias("part"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(read, f"doc_id {kind}, part string, mask int, h1 long, h2 long").groupBy("doc_id", "part", "mask", "h1", "h2").agg(F.count("*").alias("n"))


class Repeats:
    """Counting Bloom filter over the texts' hashes: has() is false only for texts that a single row has.

    Each task counts the slots of its own rows and the counts are summed; of
    these, a bit for each slot, whether two rows or more hit it, comes to the driver.
    """

    def __init__(self, seen: DataFrame) -> None:
        """seen: h1, h2, n."""
        n = seen.agg(F.sum("n")).first()[0] or 0
        self.bits = min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))
        low = f"{(1 << self.bits) - 1}L"
        slots = F.array_distinct(F.array(*(F.expr(f"cast(((h1 & {low}) + {i}L * (h2 & {low})) & {low} as int)") for i in range(PROBES))))
        counts = seen.select(F.explode(slots).alias("slot"), "n").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1")
        words = counts.groupBy(F.shiftright("slot", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, slot & 31)")).alias("bits")).toArrow()
        self.map = np.zeros(1 << (self.bits - 5), np.uint32)
        self.map[words.column("w").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        hit = np.ones(len(h1), bool)
        for s in _slots(h1, h2, self.bits):
            hit &= (self.map[s >> 5] >> (s & 31).astype(np.uint32)) & 1 == 1
        return hit


def first_ids(docs: DataFrame, repeats: Repeats) -> DataFrame:
    """first, h1, h2: the smallest id and the hashes of each text that the filter does not clear."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 1):
                h1, h2 = _hashes(part.column(1).to_pylist())
                hit = repeats.has(h1, h2)
                keep = pa.array(np.flatnonzero(hit))
                yield pa.RecordBatch.from_arrays([part.column(0).take(keep), part.column(1).take(keep), pa.array(h1[hit]), pa.array(h2[hit])], names=["doc_id", "text", "h1", "h2"])

    picked = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = picked.mapInArrow(possible, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, text string, h1 long, h2 long")
    return texts.groupBy("text").agg(F.min("doc_id").alias("first"), F.first("h1").alias("h1"), F.first("h2").alias("h2")).select("first", "h1", "h2")


def with_repeats(seen: DataFrame, docs: DataFrame) -> DataFrame:
    """seen with E's bit in its masks: set where the filter does not clear a row's text and the row is not the text's first."""
    repeats = Repeats(seen)

    def doubtful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("doubtful", pa.array(repeats.has(b.column("h1").to_numpy(), b.column("h2").to_numpy())))

    marked = seen.mapInArrow(doubtful, T.StructType([*seen.schema.fields, T.StructField("doubtful", T.BooleanType())]))
    firsts = first_ids(docs, repeats).withColumns({"doc_id": F.col("first")})
    late = F.col("doubtful") & F.col("doc_id").isNotNull() & F.col("first").isNull()
    return marked.join(firsts, ["doc_id", "h1", "h2"], "left").withColumn("mask", F.col("mask") + F.when(late, 1 << 4).otherwise(0))


def mask_counts(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good and toxic: documents of each mask in each part, and those that labels call so."""
    flags = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(f"_{name}") for c, name in (("quality", "good"), ("toxic", "toxic"))))
    counted = masked.select("doc_id", "part", "mask", "n").join(flags, "doc_id", "left")
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), *(F.sum(F.when(F.col(f"_{c}"), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")))


def orders(counts: DataFrame) -> DataFrame:
    """The figures of every order of filters and step for each part, from mask_counts()."""
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    every = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    rows = cells.select("part", "cells", F.explode(every).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def bit(letter: str) -> str:
        return f"shiftleft(1, ascii({letter}) - {ord('A')})"

    rows = rows.withColumns({"own": F.expr(bit("substring(filter_order, step, 1)")), "before": F.expr(f"aggregate(sequence(1, step), 0, (m, i) -> m | {bit('substring(filter_order, i, 1)')})")})
    rows = rows.withColumn("before", F.col("before") - F.col("own"))

    def total(what: str, where: str) -> Column:
        return F.expr(f"aggregate(cells, 0L, (s, c) -> s + if({where}, {what}, 0L))")

    here = "c.mask & own <> 0 and c.mask & before = 0"
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("c.n", "c.mask & (before | own) = 0").alias("kept"),
        total("c.n", here).alias("removed"),
        total("c.n", "c.mask & own <> 0 and c.mask & before <> 0").alias("redundant"),
        total("c.n", "c.mask = own").alias("unique_fails"),
        total("c.good", here).alias("good_lost"),
        total("c.toxic", here).alias("toxic_lost"),
        # Of all orders, each of a mask's filters comes first in the same share.
        total(f"c.n * ({len(list(permutations(FILTERS)))}L div bit_count(c.mask))", "c.mask & own <> 0").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of that step, for docs (doc_id, text, source) and labels (doc_id, quality, toxic)."""
    seen = materialise(masks(docs), "filter-masks")
    counts = materialise(mask_counts(with_repeats(seen, docs), labels), "filter-counts")
    discard(seen)
    return orders(counts)
