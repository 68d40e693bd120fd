"""Mixing to target weights with soft domain membership.

1. A classifier, trained on a bounded sample of the labelled table, gives each
   document posteriors of the domains (each combination of label values).
2. Nonnegative rates, one for each document, are fitted so that the expected
   tokens of each domain (tokens times rate times posterior) match the targets:
   projected gradient descent on least squares, distributed. A step only needs
   the residuals of the domains; a document's rate follows from its posteriors
   and the residuals of all steps so far, so nothing is kept on executors, and
   each step is one pass over (tokens, posteriors) with one short sum per task.
   Residuals are weighted by the inverse of the domains' second moments, so
   that steps of length one converge.
3. A document's copies are its rate, rounded up or down by a hash of its id with
   the right expectation.

Nulls and edge cases: a text that is null or has no word has no tokens; it gets
the domains' shares as posteriors and a rate as any other. Labels that are null,
or of no document, teach nothing. Without any labelled document there is one
domain, 'all', and all rates are 1. Targets of domains that no label shows are
left out, and the others scaled to sum to one; domains without a target get 0.
Repeated rows get the same rate. Extra columns are ignored; mix() passes them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, class_sample, discard, fresh, lower_words, materialise, slices

#: Labelled documents of each domain at most (by hash of the id), and words that the classifier knows.
PER_DOMAIN, VOCABULARY = 800, 4096
#: Shares of the tokens by domain, as quality and toxicity label it.
TARGETS = {"quality=1,toxic=0": 0.92, "quality=0,toxic=0": 0.06, "quality=1,toxic=1": 0.02, "quality=0,toxic=1": 0.0}
STEPS, TOLERANCE = 40, 1e-4


@dataclass
class Model:
    domains: list[str]
    vocabulary: dict[bytes, int]
    weights: np.ndarray  # (VOCABULARY + extras) x domains
    bias: np.ndarray

    def posteriors(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and posteriors of each text."""
        x, n = np.zeros((len(texts), len(self.domains)), np.float32), np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            words = lower_words(t)
            n[i] = len(words)
            if words and len(self.domains) > 1:
                at, v = features(words, self.vocabulary)
                x[i] = v @ self.weights[at]
        x += self.bias
        e = np.exp(x - x.max(1, keepdims=True)).astype(np.float64)
        return n, e / e.sum(1, keepdims=True)


_MARKS = (b"!", b"*", b"#", b"%", b"&", b"$", b"|", b".")


def features(words: list[bytes], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values: the known words, then the shares of words that end in certain marks and of words that repeat the one before."""
    counts: dict[int, int] = {}
    for w in words:
        k = vocabulary.get(w)
        if k is not None:
            counts[k] = counts.get(k, 0) + 1
    at = np.fromiter(counts, np.int64, len(counts))
    v = 0.5 * np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    n = len(words)
    tail = b" ".join(words) + b" "
    extra = [tail.count(m + b" ") / n for m in _MARKS] + [sum(map(bytes.__eq__, words, words[1:])) / n, len(set(words)) / n]
    return np.concatenate([at, len(vocabulary) + np.arange(len(extra))]), np.concatenate([v, np.array(extra, np.float32)])


def train(docs: DataFrame, labels: DataFrame, *, columns: tuple[str, ...] = ("quality", "toxic"), per_domain: int = PER_DOMAIN, vocabulary: int = VOCABULARY) -> Model:
    """Multinomial logistic regression on about per_domain labelled documents of each domain at most; priors are those of all labels."""
    domain = F.concat_ws(",", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in columns))
    own = labels.where(F.col("doc_id").isNotNull())
    for c in columns:
        own = own.where(F.col(c).isNotNull())
    own = own.groupBy("doc_id").agg(F.max(domain).alias("_domain"))
    ids = class_sample(own, "_domain", "doc_id", per_domain, seed=6)
    prior = {r[0]: r[1] for r in own.groupBy("_domain").count().collect()}

    seen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "_domain")
    # Which words matter is settled on the executors: those in five sampled documents or more, the most frequent first.
    frequent = seen.select(F.explode(F.array_distinct(F.regexp_extract_all(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))).alias("w"))
    frequent = frequent.groupBy("w").count().where("count >= 5").orderBy(F.col("count").desc(), "w").limit(vocabulary).collect()
    words = {r.w.encode("utf-8", "surrogatepass"): i for i, r in enumerate(frequent)}

    def sparse(batches):
        for b in batches:
            for part in slices(b, 1):
                got = [features(ws, words) if (ws := lower_words(t)) else None for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *(pa.array([None if g is None else g[j].astype(k).tobytes() for g in got], pa.binary()) for j, k in ((0, np.uint16), (1, np.float32)))], names=["doc_id", "domain", "at", "v"])

    got = sorted(seen.mapInArrow(sparse, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, domain string, at binary, v binary").where("at is not null").collect())
    domains = sorted({r.domain for r in got})
    if len(domains) < 2:
        return Model(domains or ["all"], words, np.zeros((len(words) + 10, max(1, len(domains))), np.float32), np.zeros(max(1, len(domains)), np.float32))
    x = np.zeros((len(got), len(words) + 10), np.float32)
    y = np.zeros((len(got), len(domains)), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r.at, np.uint16)] = np.frombuffer(r.v, np.float32)
        y[i, domains.index(r.domain)] = 1
    share = y.mean(0)
    w, bias = np.zeros((x.shape[1], len(domains)), np.float32), np.log(share)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, 251):  # Adam, whole batch
        z = x @ w + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = x.T @ (p - y) / len(x) + 3e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    true = np.array([prior[d] for d in domains], float)
    return Model(domains, words, w, (bias + np.log(true / true.sum()) - np.log(share)).astype(np.float32))


def rates(p: np.ndarray, duals: np.ndarray) -> np.ndarray:
    """A document's rate after the steps whose weighted residuals are the rows of duals."""
    r = np.ones(len(p))
    for g in duals:
        r = np.maximum(0.0, r - p @ g)
    return r


def fit(membership: DataFrame, domains: list[str], targets: dict[str, float], *, steps: int = STEPS, tolerance: float = TOLERANCE) -> np.ndarray:
    """The steps' weighted residuals, from which rates() follow; membership: (n_tokens, p array)."""
    d = len(domains)
    t = np.array([targets.get(k, 0.0) for k in domains])
    if d < 2 or t.sum() <= 0:
        return np.zeros((0, d))
    t = t / t.sum()

    def sums(duals: np.ndarray, second: bool) -> np.ndarray:
        width = d + d * d + 1

        def run(batches):
            total = np.zeros(width)
            for b in batches:
                if b.num_rows:
                    n = b.column(0).to_numpy(zero_copy_only=False).astype(float)
                    p = np.frombuffer(b"".join(b.column(1).to_pylist()), np.float64).reshape(-1, d)
                    total[:d] += (n * rates(p, duals)) @ p
                    total[-1] += n.sum()
                    if second:
                        total[d:-1] += ((p * n[:, None]).T @ p).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total)], names=["k", "v"])

        got = {r.k: r.v for r in membership.select("n_tokens", "p").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()}
        return np.array([got.get(k, 0.0) for k in range(width)])

    first = sums(np.zeros((0, d)), True)
    total = first[-1]
    if total <= 0:
        return np.zeros((0, d))
    weight = np.linalg.inv(first[d:-1].reshape(d, d) / total + 1e-7 * np.eye(d))
    duals, mass = np.zeros((0, d)), first[:d] / total
    for _ in range(steps):
        residual = mass - t
        if np.abs(residual).max() < tolerance:
            break
        duals = np.vstack([duals, weight @ residual])
        mass = sums(duals, False)[:d] / total
    return duals


FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("p", T.BinaryType())]


def _scorer(model: Model):
    def run(texts: list) -> list[pa.Array]:
        n, p = model.posteriors(texts)
        return [pa.array(n), pa.array([r.tobytes() for r in p], pa.binary())]

    return run


def _membership(docs: DataFrame, model: Model) -> DataFrame:
    out, names = annotate(docs.select("doc_id", "text"), "text", _scorer(model), FIELDS)
    return out.select("doc_id", *(F.col(n).alias(f.name) for n, f in zip(names, FIELDS, strict=True)))


def weigh(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, **params) -> DataFrame:
    """doc_id, n_tokens, domain (the likeliest), p_domain (its posterior), posteriors (map), rate and copies for each row of docs (doc_id, text)."""
    model = train(docs, labels, **params)
    member = materialise(_membership(docs, model), "membership")
    duals, domains = fit(member, model.domains, TARGETS if targets is None else targets), model.domains

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            p = np.frombuffer(b"".join(b.column(2).to_pylist()), np.float64).reshape(-1, len(domains))
            top = p.argmax(1)
            arrays = [b.column(0), b.column(1), pa.array([domains[i] for i in top]), pa.array(p.max(1)), pa.array([list(zip(domains, r, strict=True)) for r in p.tolist()], pa.map_(pa.string(), pa.float64())), pa.array(rates(p, duals))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "domain", "p_domain", "posteriors", "rate"])

    kind = member.schema["doc_id"].dataType.simpleString()
    out = member.mapInArrow(run, f"doc_id {kind}, n_tokens long, domain string, p_domain double, posteriors map<string,double>, rate double")
    return out.withColumn("copies", _copies(F.col("doc_id"), F.col("rate")))


def _copies(doc_id, rate):
    return F.floor(rate + F.pmod(F.xxhash64(doc_id, F.lit(17)), F.lit(1 << 30)) / float(1 << 30)).cast("int")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, **params) -> DataFrame:
    """The rows of docs with at least one copy in the mixture, with all columns and their rate and copies (named with underscores before, if docs has such columns)."""
    model = train(docs, labels, **params)
    member = materialise(_membership(docs, model), "membership")
    duals = fit(member, model.domains, TARGETS if targets is None else targets)
    discard(member)
    # Scoring the texts again is cheaper than a second copy of them beside their posteriors.
    out, (rate,) = annotate(docs, "text", lambda texts: [pa.array(rates(model.posteriors(texts)[1], duals))], [T.StructField("rate", T.DoubleType())])
    names = [fresh(docs.columns, "rate"), fresh(docs.columns, "copies")]
    out = out.select(*docs.columns, F.col(rate).alias(names[0]), _copies(F.col("doc_id"), F.col(rate)).alias(names[1]))
    return out.where(F.col(names[1]) >= 1)
