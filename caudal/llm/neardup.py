"""MinHash near-duplicates with sequential Bayesian verification.

1. Each text becomes the set of 64-bit hashes of its distinct 5-word shingles.
   Texts of equal sets form a class; from then on a class is one node, named by
   its smallest id.
2. Signatures of 160 minima are cut into 40 bands of 4. A link at similarity
   0.75 shares no band with a probability of 2.5e-7. Which buckets hold several
   classes is one aggregation, reduced before its shuffle; only they go on.
3. Candidates are checked batch after batch of the signature: once the posterior
   probability that the similarity reaches the threshold is below `miss`, a pair
   is dropped; the survivors are verified on the full sets. Signatures travel
   first; full sets are made again from the texts, only of nodes that survived.
4. Candidates come in three steps that lose no link between two components:
   each node against the first node of its buckets; then each node against a
   random node of a bucket that holds another component; then, for buckets that
   still hold several components, every pair across components, in blocks of a
   few megabytes inside a task: of signatures first, which leaves the nodes that
   have a candidate at all, then of their full sets, which returns one link of a
   node to each component. Pairs within a component are never made.

What the joins by bucket need of a bucket (its first node, its components) is
written first, so that Spark can split a bucket that holds many nodes.

Nulls and edge cases: texts that are null or have no word have an empty set and
are linked with nothing; so are rows with a null id (component_id null, kept).
Rows that share an id share a component, whatever their texts. Texts of under
five words have their whole sequence as the one shingle. Ties do not arise: the
smallest id stays. Extra columns are ignored; keep() passes them through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import IdFilter, WordHashes, annotate, discard, fresh, lower_words, materialise, mix, shingles, slices
from .graph import components

SHINGLE, THRESHOLD = 5, 0.75
BANDS, ROWS, BATCH = 40, 4, 32
N_HASHES = BANDS * ROWS
MISS = 1e-7
BLOCK_BYTES = 8_000_000
_rng = np.random.default_rng(20240607)
_A = (_rng.integers(1, 1 << 32, (N_HASHES, 1), dtype=np.uint32) | np.uint32(1)).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, (N_HASHES, 1), dtype=np.uint32)
_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def signature(s: np.ndarray) -> np.ndarray:
    """Minima of N_HASHES hash functions over the 64-bit set s."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(N_HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        h = _A * x[None, i : i + 1024]
        h += _B
        h ^= h >> np.uint32(16)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        np.minimum(out, h.min(1), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    p = sig.reshape(BANDS, ROWS).astype(np.uint64)
    h = _BAND.copy()
    for j in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + p[:, j])
    return h.view(np.int64)


def set_of(text: str | None, hashes: WordHashes, k: int) -> np.ndarray:
    words = lower_words(text)
    return np.unique(shingles(hashes.of(words), k)) if words else np.zeros(0, np.uint64)


def least_matches(threshold: float, miss: float, batch: int = BATCH, n: int = N_HASHES) -> list[tuple[int, int]]:
    """(compared, fewest equal minima with which a pair goes on): below, the posterior that the similarity reaches the threshold is under miss.

    The prior of the similarity is uniform, so the posterior after m of c equal minima is Beta(m + 1, c - m + 1);
    its mass above the threshold is a binomial sum.
    """
    out = []
    for c in range(batch, n + 1, batch):
        for m in range(c + 1):
            tail = sum(math.comb(c + 1, i) * threshold**i * (1 - threshold) ** (c + 1 - i) for i in range(m + 1))
            if tail >= miss:
                break
        out.append((c, m))
    return out


def _of_nodes(docs: DataFrame, nodes: DataFrame, k: int, *, sets: bool) -> DataFrame:
    """(node, n, sig), or with `sets` (node, set), of all documents whose id is in nodes, and of few others, which do no harm: what follows joins by id."""
    wanted, hashes = IdFilter(nodes), WordHashes()

    def run(batches):
        for batch in batches:
            for b in slices(batch.filter(pa.array(wanted.has(batch.column(2).to_numpy(zero_copy_only=False)))), 1):
                got = [set_of(t, hashes, k) for t in b.column(1).to_pylist()]
                if sets:
                    out = pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in got], pa.binary())], names=["node", "set"])
                else:
                    out = pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in got], pa.int32()), pa.array([signature(x).tobytes() for x in got], pa.binary())], names=["node", "n", "sig"])
                yield out.filter(pa.array([len(x) > 0 for x in got], pa.bool_()))

    own = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("node"), "text", wanted.slot(F.col("doc_id").cast("long")).alias("slot"))
    return own.mapInArrow(run, "node long, set binary" if sets else "node long, n int, sig binary")


def _same(a: np.ndarray, b: np.ndarray, limits: list[tuple[int, int]]) -> np.ndarray:
    """Rows of the signature matrices a and b that outlast every batch."""
    alive, equal, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for c, m in limits:
        equal[alive] += (a[alive, done:c] == b[alive, done:c]).sum(1)
        alive, done = alive[equal[alive] >= m], c
        if not len(alive):
            break
    return alive


def _alike(n: np.ndarray | int, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of so many elements can be as similar as that."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def promising(pairs: DataFrame, sigs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """The pairs (a, b) that outlast every batch of the signatures (node, n, sig)."""
    limits, percent = least_matches(threshold, miss), round(threshold * 100)
    side = lambda x: sigs.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))

    def run(batches):
        for b in batches:
            if b.num_rows:
                b = b.filter(pa.array(_alike(*(b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3)), percent)))
            if b.num_rows:
                sa, sb = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint32).reshape(-1, N_HASHES) for i in (4, 5))
                at = pa.array(_same(sa, sb, limits), pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at)], names=["a", "b"])

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b")
    return both.mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, k: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as that."""
    percent = round(threshold * 100)
    sets = _of_nodes(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), k, sets=True)
    side = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))

    def run(batches):
        for b in batches:
            good = []
            for i in range(b.num_rows):
                x, y = (np.frombuffer(b.column(j)[i].as_py(), np.uint64) for j in (2, 3))
                both = len(np.intersect1d(x, y, assume_unique=True)) if _alike(len(x), len(y), percent) else 0
                if 100 * both >= percent * (len(x) + len(y) - both):
                    good.append(i)
            at = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at)], names=["a", "b"])

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(run, "a long, b long").distinct()


def _rivals(na, ca, sa, la, nb, cb, sb, lb, i: int, band: int, own: bool, limits, percent: int) -> np.ndarray:
    """Which of the nodes b are a candidate for node i of a: of another component, of a like size, outlasting the signature batches, and sharing no earlier band (such a pair is looked at there)."""
    j = np.flatnonzero((ca[i] != cb) & _alike(la[i], lb, percent) & ((na[i] < nb) if own else True))
    j = j[_same(np.broadcast_to(sa[i], (len(j), N_HASHES)), sb[j], limits)]
    if not len(j):
        return j
    return j[(sb[j].reshape(-1, BANDS, ROWS) == sa[i].reshape(BANDS, ROWS)).all(2).argmax(1) == band]


def _side(rows: list[dict]) -> tuple:
    ids, c, n = (np.array([x[k] for x in rows], np.int64) for k in ("node", "c", "n"))
    return ids, c, np.frombuffer(b"".join(x["sig"] for x in rows), np.uint32).reshape(-1, N_HASHES), n


def _blocks(batches):
    """bucket, rows on the left, rows on the right or None."""
    for b in batches:
        for k in range(b.num_rows):
            yield tuple(b.column(x)[k].as_py() for x in ("bucket", "left", "right"))


def _rival_nodes(blocks: DataFrame, limits: list[tuple[int, int]], percent: int) -> DataFrame:
    """(bucket, node) of the nodes that are a candidate across components, from blocks of signatures."""

    def run(batches):
        for bucket, left, right in _blocks(batches):
            na, ca, sa, la = _side(left)
            nb, cb, sb, lb = _side(right) if right is not None else (na, ca, sa, la)
            band = int((band_keys(sa[0]) == bucket).argmax())
            a, b = np.zeros(len(na), bool), np.zeros(len(nb), bool)
            for i in range(len(na)):
                j = _rivals(na, ca, sa, la, nb, cb, sb, lb, i, band, right is None, limits, percent)
                a[i] |= len(j) > 0
                b[j] = True
            ids = np.unique(np.concatenate([na[a], nb[b]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), bucket, np.int64)), pa.array(ids)], names=["bucket", "node"])

    return blocks.mapInArrow(run, "bucket long, node long").distinct()


def _across(blocks: DataFrame, limits: list[tuple[int, int]], percent: int) -> DataFrame:
    """Links between components, from blocks of signatures and sets: for each node one link to each component that it has any to."""

    def run(batches):
        for bucket, left, right in _blocks(batches):
            out_a, out_b = [], []
            na, ca, sa, la = _side(left)
            nb, cb, sb, lb = _side(right) if right is not None else (na, ca, sa, la)
            xa = [np.frombuffer(x["set"], np.uint64) for x in left]
            xb = [np.frombuffer(x["set"], np.uint64) for x in right] if right is not None else xa
            band = int((band_keys(sa[0]) == bucket).argmax())
            for i in range(len(na)):
                j = _rivals(na, ca, sa, la, nb, cb, sb, lb, i, band, right is None, limits, percent)
                if not len(j):
                    continue
                y = np.concatenate([xb[q] for q in j])
                at = np.minimum(np.searchsorted(xa[i], y), la[i] - 1)
                both = np.add.reduceat((xa[i][at] == y).astype(np.int64), np.cumsum(lb[j]) - lb[j])
                j = j[100 * both >= percent * (la[i] + lb[j] - both)]
                for q in np.unique(cb[j], return_index=True)[1]:
                    out_a.append(int(na[i]))
                    out_b.append(int(nb[j[q]]))
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return blocks.mapInArrow(run, "a long, b long")


def _in_blocks(rows: DataFrame, size: Column, payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bucket, left, right) and the written table below it, from rows (bucket, node, c) that each take about `size` bytes with their payload, which is joined by node: each block of a bucket, and each pair of a bucket's blocks."""
    sizes = materialise(rows.groupBy("bucket").agg(F.ceil(F.sum(size) / BLOCK_BYTES).cast("int").alias("nb")), "sizes")
    cells = rows.select("bucket", "node", "c").join(sizes, "bucket").withColumn("i", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")).join(payload, "node")
    cells = materialise(cells.groupBy("bucket", "nb", "i").agg(F.collect_list(F.struct("c", *payload.columns)).alias("left")), "cells")
    discard(sizes)
    wide = cells.where("nb > 1")
    pairs = wide.withColumn("j", F.explode(F.expr("filter(sequence(0, nb - 1), x -> x > i)"))).join(wide.select("bucket", F.col("i").alias("j"), F.col("left").alias("right")), ["bucket", "j"])
    return cells.select("bucket", "left", F.lit(None).cast(cells.schema["left"].dataType).alias("right")).union(pairs.select("bucket", "left", "right")), cells


def _labelled(members: DataFrame, comp: DataFrame) -> DataFrame:
    """members with the component c of each node, of the buckets that hold several components."""
    own = materialise(members.join(comp, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("c")), "labelled")
    mixed = own.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where(F.col("lo") < F.col("hi")).select("bucket")
    return materialise(own.join(materialise(mixed, "mixed"), "bucket"), "left")


def _members(digests: DataFrame, classes: DataFrame) -> DataFrame:
    """(bucket, node): the nodes of each bucket that holds several classes. Buckets of several rows come first, then those rows' classes."""
    shared = materialise(digests.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("rows")).where("rows > 1").select("bucket"), "shared")
    wanted = IdFilter(shared)
    discard(shared)

    def some(batches):
        for b in batches:
            row = np.repeat(np.arange(b.num_rows), np.diff(b.column(3).offsets.to_numpy()))
            at = np.flatnonzero(wanted.has(b.column(4).flatten().to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(pa.array(row[at])) for i in range(3)), b.column(3).flatten().take(pa.array(at))], names=["n", "k1", "k2", "bucket"])

    found = digests.select("n", "k1", "k2", "bands", F.transform("bands", wanted.slot).alias("slots")).mapInArrow(some, "n long, k1 long, k2 long, bucket long")
    found = materialise(found.distinct(), "found")
    several = materialise(found.groupBy("bucket").agg(F.count("*").alias("classes")).where("classes > 1").select("bucket"), "several")
    return found.join(several, "bucket").join(classes, ["n", "k1", "k2"]).select("bucket", "node").distinct()


def groups(docs: DataFrame, *, shingle: int = SHINGLE, threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs (doc_id, text)."""
    hashes = WordHashes()

    def digest(texts: list) -> list[pa.Array]:
        n, k1, k2, keys = [], [], [], []
        for t in texts:
            s = set_of(t, hashes, shingle)
            n.append(len(s))
            if len(s):
                m = mix(s + np.uint64(0x51ED270B27A4F2E3))
                k1.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                k2.append(int(mix(np.bitwise_xor.reduce(m, keepdims=True) + m.sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0]))
                keys.append(band_keys(signature(s)))
            else:
                k1.append(None)
                k2.append(None)
                keys.append(None)
        return [pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]

    fields = [T.StructField("n", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))]
    out, names = annotate(docs.select("doc_id", "text"), "text", digest, fields)
    digests = materialise(out.select("doc_id", *(F.col(c).alias(f.name) for c, f in zip(names, fields, strict=True))), "digests")
    limits, percent = least_matches(threshold, miss), round(threshold * 100)

    # A class is named by its smallest id.
    key = ["n", "k1", "k2"]
    usable = digests.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = materialise(usable.groupBy(*key).agg(F.min("doc_id").cast("long").alias("node")), "classes")
    members = materialise(_members(usable, classes), "members")
    sigs = materialise(_of_nodes(docs, members.select("node").distinct(), shingle, sets=False), "signatures")

    # Rows that share an id but not their text.
    again = usable.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    twins = usable.join(again, "doc_id").join(classes, key).select(F.col("doc_id").cast("long").alias("a"), F.col("node").alias("b")).where("a != b").distinct()

    # Step 1: each node against the smallest of all first nodes of its buckets.
    first = materialise(members.groupBy("bucket").agg(F.min("node").alias("first")), "first")
    pairs = members.join(first, "bucket").where(F.col("node") != F.col("first")).groupBy("node").agg(F.min("first").alias("b")).select(F.col("node").alias("a"), "b")
    pairs = materialise(promising(pairs, sigs, threshold, miss), "pairs1")
    links = materialise(twins.union(verified(pairs, docs, shingle, threshold)), "links1")
    comp = materialise(components(links), "comp1")

    # Step 2: a random node of each bucket that still holds several components, against the nodes of the others.
    own = _labelled(members, comp)
    lead = materialise(own.groupBy("bucket").agg(F.min_by(F.struct("node", "c"), F.xxhash64("node")).alias("lead")), "lead")
    pairs = own.join(lead, "bucket").where(F.col("c") != F.col("lead.c")).groupBy("node").agg(F.min_by(F.col("lead.node"), F.xxhash64(F.col("lead.node"))).alias("b")).select(F.col("node").alias("a"), "b")
    pairs = materialise(promising(pairs, sigs, threshold, miss), "pairs2")
    links = materialise(links.union(verified(pairs, docs, shingle, threshold)), "links2")
    comp = materialise(components(links), "comp2")

    # Step 3: all pairs across components that are left.
    left = _labelled(members, comp)
    blocks, cells = _in_blocks(left, F.lit(4 * N_HASHES + 32), sigs)
    rivals = materialise(_rival_nodes(blocks, limits, percent).join(left, ["bucket", "node"]).join(sigs.select("node", "n"), "node"), "rivals")
    discard(cells)
    sets = _of_nodes(docs, rivals.select("node").distinct(), shingle, sets=True)
    blocks, cells = _in_blocks(rivals, 8 * F.col("n") + 4 * N_HASHES + 32, sigs.join(sets, "node").where(F.length("set") == 8 * F.col("n")))
    links = materialise(links.union(_across(blocks, limits, percent)), "links3")
    comp = materialise(components(links), "comp3")
    for x in (cells, rivals, left, own, lead, pairs, first, sigs, members, links):
        discard(x)

    named = classes.join(comp, "node", "left").select(*key, F.coalesce("comp", "node").alias("component_id"))
    alone = digests.where((F.col("n") == 0) | F.col("doc_id").isNull()).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    both = usable.join(named, key).select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(alone)
    return both.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep(docs: DataFrame, **params) -> DataFrame:
    """The rows of docs that groups() keeps, with all columns: one document of each group, that of the smallest id (rows that share an id are one document).

    Rows without words or without an id all stay. Only rows whose id may be one to go are shuffled.
    """
    gone = materialise(groups(docs, **params).where(~F.col("kept")).select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "gone")
    wanted, name = IdFilter(gone), fresh(docs.columns, "_slot")
    at = len(docs.columns)

    def doubtful(yes: bool):
        def run(batches):
            for b in batches:
                hit = wanted.has(b.column(at).fill_null(0).to_numpy(zero_copy_only=False)) & b.column(at).is_valid().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(b.columns[:at], names=b.schema.names[:at]).filter(pa.array(hit == yes))

        return run

    slotted = docs.withColumn(name, F.when(F.col("doc_id").isNotNull(), wanted.slot(F.col("doc_id").cast("long"))))
    sure, rest = (slotted.mapInArrow(doubtful(yes), docs.schema) for yes in (False, True))
    return sure.union(rest.join(gone, "doc_id", "left_anti").select(*docs.columns))
