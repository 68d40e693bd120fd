"""Language identification by nearest centroid.

A text becomes a normalised TF-IDF vector of hashed byte n-grams (1 to 4) of its
lower-cased letters. Each language has several centroids, found by spherical
k-means over labelled documents; the prediction is the language of the centroid
with the greatest cosine. A text farther from its centroid than any ordinary
training text by a margin is rejected.

Nulls and edge cases: a null text, or one without a letter, is 'und' with score
0 and rejected. Rows without lang, or without an id, train nothing. Without a
training row every text is 'und'. Ties go to the language first in order of
name. Texts of fewer than min_letters letters are never rejected by distance:
they say too little. Repeated rows are predicted each on its own, extra columns
are ignored, or passed through by keep().
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, bucket_of, class_sample, slices

BITS = 13
DIMS = 1 << BITS
#: Training rows of each language (a bounded sample by hash of the id), and centroids of each.
PER_LANGUAGE, CENTROIDS = 400, 4
#: A text is rejected below this share of the lowest hundredth of its language's training cosines.
MARGIN, MIN_LETTERS = 0.5, 24
_LETTERS = bytes(b if (97 <= b <= 122 or b >= 0x80) else 32 for b in range(256))


def letters(text: str | None) -> bytes:
    """Lower-cased letters, each run of anything else as one blank; empty if there is no letter."""
    if not text:
        return b""
    out = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())
    if out and not text.isascii() and not any(map(str.isalpha, text)):
        return b""
    return out


def gram_counts(norm: bytes) -> np.ndarray:
    """Counts of hashed n-grams."""
    a = np.frombuffer(b" " + norm + b" ", np.uint8).astype(np.uint32)
    out = np.zeros(DIMS, np.int64)
    g = a
    for k in range(1, 5):
        if k > 1:
            g = (g[:-1] << np.uint32(8)) | a[k - 1 :]
        if len(g):
            h = ((g + np.uint32(k * 0x3C6EF372)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
            out += np.bincount(h, minlength=DIMS)
    return out


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray  # DIMS
    centroids: np.ndarray  # rows of all languages
    owner: np.ndarray  # language of each row
    floor: np.ndarray  # of each language


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; the first centre is the mean's nearest row, the others are the rows farthest from those before."""
    k = min(k, len(x))
    at = [int((x @ x.mean(0)).argmax())]
    while len(at) < k:
        at.append(int((x @ x[at].T).max(1).argmin()))
    c = x[at]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        c = unit(np.stack([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(k)]))
    return c


def train(docs: DataFrame, *, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS, held_out: tuple[int, int] | None = None) -> Model:
    """Fits the model on at most about per_language documents of each lang. held_out: (modulus, remainder) of crc32(doc_id) that it must not see.

    The driver gets the sample's sparse counts, a few kilobytes for each sampled document.
    """
    rows = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    if held_out:
        rows = rows.where(bucket_of("doc_id", held_out[0]) != held_out[1])
    chosen = class_sample(rows, "lang", "doc_id", per_language, seed=3)

    def sparse(batches):
        for b in batches:
            for part in slices(b, 1):
                out = []
                for t in part.column(1).to_pylist():
                    c = gram_counts(letters(t)) if letters(t) else np.zeros(DIMS, np.int64)
                    at = np.flatnonzero(c)
                    out.append((at.astype(np.uint16).tobytes(), c[at].astype(np.float32).tobytes()))
                yield pa.RecordBatch.from_arrays([part.column(2), pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary())], names=["lang", "at", "n"])

    got = sorted((r.lang, bytes(r.at), bytes(r.n)) for r in chosen.select("doc_id", "text", "lang").mapInArrow(sparse, "lang string, at binary, n binary").collect())
    got = [(k, np.frombuffer(a, np.uint16), np.frombuffer(n, np.float32)) for k, a, n in got if a]
    seen = np.zeros(DIMS)
    for _, a, _ in got:
        seen[a] += 1
    idf = (np.log((1 + len(got)) / (1 + seen)) + 1).astype(np.float32)
    langs = sorted({k for k, _, _ in got})
    parts, owner, floor = [], [], []
    for i, k in enumerate(langs):
        own = [(a, n) for lang, a, n in got if lang == k]
        x = np.zeros((len(own), DIMS), np.float32)
        for j, (a, n) in enumerate(own):
            x[j, a] = np.log1p(n)
        x = unit(x * idf)
        c = kmeans(x, centroids)
        parts.append(c)
        owner += [i] * len(c)
        floor.append(MARGIN * float(np.quantile((x @ c.T).max(1), 0.01)))
    return Model(langs, idf, np.concatenate(parts) if parts else np.zeros((0, DIMS), np.float32), np.array(owner, np.int64), np.array(floor))


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("cosine", T.DoubleType()), T.StructField("rejected", T.BooleanType())]


def _scorer(m: Model, min_letters: int):
    starts = np.flatnonzero(np.diff(m.owner, prepend=-1)) if len(m.owner) else np.array([], np.int64)
    turned = np.ascontiguousarray(m.centroids.T)

    def score(texts: list) -> list[pa.Array]:
        norm = [letters(t) for t in texts]
        n = np.array([len(x) for x in norm])
        lang: list = ["und"] * len(texts)
        prob, cosine, rejected = np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), bool)
        has = np.flatnonzero(n > 0)
        if len(has) and m.langs:
            x = np.stack([gram_counts(norm[i]) for i in has]).astype(np.float32)
            x = unit(np.log1p(x) * m.idf)
            best = np.maximum.reduceat(x @ turned, starts, axis=1)  # of each language
            top = best.argmax(1)
            e = np.exp(24.0 * (best - best.max(1, keepdims=True)))
            prob[has] = np.clip(1 / e.sum(1), 0, 1)
            cosine[has] = best[np.arange(len(has)), top]
            rejected[has] = (n[has] >= min_letters) & (cosine[has] < m.floor[top])
            for i, k in zip(has, top, strict=True):
                lang[i] = m.langs[k]
        return [pa.array(lang, pa.string()), pa.array(prob), pa.array(cosine), pa.array(rejected)]

    return score


def predict(docs: DataFrame, model: Model, *, min_letters: int = MIN_LETTERS) -> DataFrame:
    """doc_id and the columns of FIELDS for each row of docs (doc_id, text)."""
    out, names = annotate(docs.select("doc_id", "text"), "text", _scorer(model, min_letters), FIELDS)
    return out.select("doc_id", *(F.col(n).alias(f.name) for n, f in zip(names, FIELDS, strict=True)))


def keep(docs: DataFrame, model: Model, *, min_letters: int = MIN_LETTERS) -> DataFrame:
    """The rows of docs whose language is identified, with all their columns and in one pass."""
    score = _scorer(model, min_letters)
    out, names = annotate(docs, "text", lambda texts: [score(texts)[3]], [FIELDS[3]])
    return out.where(~F.col(names[0])).select(*docs.columns)
