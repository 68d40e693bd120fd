"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text is described by three groups of counts, each scaled to length one:
hashed byte trigrams, hashed word shapes, and how far back each word occurred
before. Latent-semantic vectors are the projections on the leading singular
vectors of the labelled sample's TF-IDF matrix. Every document is compared with
every labelled vector by cosine, in blocks, exactly; the nearest vote with
their similarity.

Nulls and edge cases: a text that is null, or has no word, has no neighbours and
gets score 0. Labels that are null, or of documents that are not in the table,
teach nothing; of several labels of a document the greatest counts. Without
labelled rows every score is 0. Of neighbours of equal cosine at the last place
those of the smaller id vote. Repeated rows are scored each on its own. Extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, bucket_of, class_sample, slices

GRAMS, SHAPES, RECENT = 2048, 512, 12
DIMS = GRAMS + SHAPES + RECENT
#: Labelled rows of each label (a bounded sample by hash of the id), latent dimensions, voters, and the power of their similarity.
PER_LABEL, LATENT, VOTERS, POWER, CUT = 1000, 48, 32, 8.0, 0.3
_SHAPE = bytes(97 if (97 <= b <= 122 or b >= 0xC0) else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))
_EDGE = [1, 2, 3, 4, 8, 16, 32, 64, 128, 256]


class _Shapes(dict):
    """The hashed shape of a word: letters, capitals and figures as a, A and 0, runs as one, anything else as it is."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        s = np.frombuffer(word.translate(_SHAPE)[:512], np.uint8)
        s = s[np.append(True, s[1:] != s[:-1])][:8].astype(np.uint64)
        h = 0
        for b in s.tolist():
            h = (h * 131 + b + 1) & 0xFFFFFFFF
        h = self[word] = ((h * 2654435761) & 0xFFFFFFFF) * SHAPES >> 32
        return h


def counts(text: str | None, shapes: _Shapes) -> np.ndarray | None:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return None
    out = np.zeros(DIMS, np.float32)
    a = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    g = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
    out[:GRAMS] = np.bincount((g * np.uint32(2654435761)) >> np.uint32(21), minlength=GRAMS)
    out[GRAMS : GRAMS + SHAPES] = np.bincount(np.fromiter(map(shapes.__getitem__, words), np.int64, len(words)), minlength=SHAPES)
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
    order = np.argsort(w, kind="stable")
    back = np.full(len(w), 1 << 40)
    gap = np.diff(order)
    same = w[order[1:]] == w[order[:-1]]
    back[order[1:][same]] = gap[same]
    out[GRAMS + SHAPES :] = np.bincount(np.searchsorted(_EDGE, back), minlength=RECENT)[:RECENT]
    return out


def _scaled(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(x) * idf
    for lo, hi in ((0, GRAMS), (GRAMS, GRAMS + SHAPES), (GRAMS + SHAPES, DIMS)):
        x[:, lo:hi] /= np.maximum(np.linalg.norm(x[:, lo:hi], axis=1, keepdims=True), 1e-12)
    return x


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray  # DIMS x LATENT
    vectors: np.ndarray  # LATENT x labelled rows, of length one
    labels: np.ndarray


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", per_label: int = PER_LABEL, latent: int = LATENT, held_out: tuple[int, int] | None = None) -> Model:
    """Fits on at most about per_label documents of each value of labels[label] (0 or 1).

    The sample is drawn from the ids of `labels`, so it is small before texts are looked up; it is joined by broadcast (at most about 2 * per_label ids).
    """
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    if held_out:
        own = own.where(bucket_of("doc_id", held_out[0]) != held_out[1])
    own = own.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    ids = class_sample(own, "_label", "doc_id", per_label, seed=9)

    def features(batches):
        shapes = _Shapes()
        for b in batches:
            for part in slices(b, 1):
                got = [counts(t, shapes) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([None if g is None else g.astype(np.float32).tobytes() for g in got], pa.binary())], names=["doc_id", "label", "x"])

    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "_label")
    got = rows.mapInArrow(features, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label int, x binary").where("x is not null").collect()
    got.sort(key=lambda r: (r.doc_id, r.label, bytes(r.x)))
    if not got:
        return Model(np.ones(DIMS, np.float32), np.zeros((DIMS, 1), np.float32), np.zeros((1, 0), np.float32), np.zeros(0))
    x = np.stack([np.frombuffer(r.x, np.float32) for r in got])
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
    x = _scaled(x, idf)
    values, vectors = np.linalg.eigh(x.T.astype(np.float64) @ x if len(x) > DIMS else x.astype(np.float64) @ x.T)
    top = np.argsort(values)[::-1][: min(latent, len(values))]
    top = top[values[top] > 1e-9]
    basis = vectors[:, top] if len(x) > DIMS else x.T @ vectors[:, top] / np.sqrt(values[top])
    basis = basis.astype(np.float32)
    z = x @ basis
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    return Model(idf, basis, np.ascontiguousarray(z.T), np.array([r.label for r in got], float))


def score(docs: DataFrame, model: Model, *, voters: int = VOTERS, cut: float = CUT) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier), predicted (1 from cut on) and nearest (the greatest cosine) for each row of docs (doc_id, text)."""
    shapes = _Shapes()
    k = min(voters, len(model.labels))

    def run(texts: list) -> list[pa.Array]:
        got = [counts(t, shapes) for t in texts]
        s, near = np.zeros(len(texts)), np.zeros(len(texts))
        has = [i for i, g in enumerate(got) if g is not None]
        if has and k:
            z = _scaled(np.stack([got[i] for i in has]), model.idf) @ model.basis
            z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
            c = z @ model.vectors
            last = np.partition(c, len(model.labels) - k, axis=1)[:, len(model.labels) - k, None]  # the k-th greatest
            ties = c == last
            votes = (c > last) | (ties & (np.cumsum(ties, 1) <= k - (c > last).sum(1, keepdims=True)))
            w = np.where(votes, np.maximum(c, 0.0), 0.0) ** POWER
            s[has] = np.clip(w @ model.labels / np.maximum(w.sum(1), 1e-300), 0, 1)
            near[has] = c.max(1)
        return [pa.array(s), pa.array((s >= cut).astype(np.int32)), pa.array(near)]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("nearest", T.DoubleType())]
    out, names = annotate(docs.select("doc_id", "text"), "text", run, fields)
    return out.select("doc_id", *(F.col(n).alias(f.name) for n, f in zip(names, fields, strict=True)))
