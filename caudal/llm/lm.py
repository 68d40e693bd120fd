"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

Counts of all words of the training documents come first. The end, the frequent
words (LEAST occurrences or more, as many as UNITS leaves room for) and TAILS
tails, to which all other words, known or not, belong by their last letters, are
the units of the neural model. Its softmax is factored: units of near frequency
form a class, and

    P(unit | a, b) = P(class | a, b) P(unit | class, a, b)
    log P(class | a, b) = (C1[a] + C2[b]) . R[class] + bias[class] - log Z[a, b]
    log P(unit | class, a, b) = (C1[a] + C2[b]) . S[unit] + bias[unit] - log Z[class, a, b]

for the units a and b before; a word within its tail counts by its smoothed
share. Both normalisers are exact, by batched matrix products over all classes
and over all units of the token's class, so token probabilities sum to one. The
model starts as the unigram one.

Training reads every training token EPOCHS times (once), at any size.
A hash deals the documents to ROUNDS rounds and, within a round, to shards of
about SHARD tokens. A shard's documents come together, in order of id, and take
gradient steps of noise-contrastive estimation at both levels; then each row of
parameters becomes the mean over the shards, weighted by the shard's use of the
row, and the next round starts there. Shards depend on the number of tokens
alone, so scores are the same, but for rounding, however the table is laid out.

The most frequent words, HEAVY at most (a histogram of the counts says from which
count on), travel to the tasks; the counts of all others are joined by hash. Words
are told apart by 64-bit hashes.

Nulls and edge cases: a null text is empty: one token, the end. A null id counts
as the empty text for the split. Without training documents N and V are 0, so
every base probability is 1, and the model gives all units the same probability.
Repeated rows are scored each. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_of, lower_words, materialise, mix, slices

#: Units at most (so the model has a bound), how often a word of its own occurs at least, dimensions, noise samples for classes and for units, tokens of a step.
UNITS, TAILS, LEAST, DIMS, NOISE, WITHIN, BATCH = 1 << 15, 192, 8, 15, 24, 1, 1024
ROUNDS, EPOCHS, SHARD, RATE = 4, 1, 4_000_000, 0.3
HEAVY = 1 << 19
END = b""


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def tails_of(words: list[bytes]) -> np.ndarray:
    """The tail of each word, by its last three bytes."""
    x = np.frombuffer(b"".join([w[-3:].rjust(3, b"\0") for w in words]), np.uint8).reshape(-1, 3).astype(np.uint32)
    return (((x[:, 0] << 16 | x[:, 1] << 8 | x[:, 2]) * np.uint32(2654435761)).astype(np.uint64) * np.uint64(TAILS) >> np.uint64(32)).astype(np.int32)


def word_counts(train: DataFrame) -> DataFrame:
    """(h, tail, n): how often each token occurs in the texts of train; the end has tail -1."""

    def count(batches):
        left: Counter = Counter()

        def rows():
            ws = list(left)
            tail = tails_of(ws)
            if END in left:
                tail[ws.index(END)] = -1
            out = pa.RecordBatch.from_arrays([pa.array(hashes(ws).view(np.int64)), pa.array(tail), pa.array(left.values(), pa.int64())], names=["h", "tail", "n"])
            left.clear()
            return out

        for b in batches:
            for part in slices(b, 0):
                for t in part.column(0).to_pylist():
                    left.update(lower_words(t))
                left[END] += part.num_rows
                if len(left) > 600_000:
                    yield rows()
        if left:
            yield rows()

    return train.select("text").mapInArrow(count, "h long, tail int, n long").groupBy("h", "tail").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    total: int  # N
    kinds: int  # V
    heavy: np.ndarray  # sorted hashes of the frequent words
    n: np.ndarray  # their counts
    unit: np.ndarray  # their units
    level: int  # level() of the least of them
    end: int  # unit of the end
    tail: np.ndarray  # unit of each tail
    within: np.ndarray  # by unit: for tails the log10 of their smoothed mass, else 0
    mass: np.ndarray  # smoothed count of each unit, falling
    first: np.ndarray  # first unit of each class, and the number of units

    @property
    def units(self) -> int:
        return len(self.mass)

    @property
    def classes(self) -> int:
        return len(self.first) - 1

    @property
    def of(self) -> np.ndarray:
        """The class of each unit."""
        return np.repeat(np.arange(self.classes), np.diff(self.first))


class Places:
    """Where hashes are in a sorted array of hashes: open addressing over twice as many slots."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = hashes.view(np.uint64)
        self.shift = np.uint64(64 - max(4, (2 * len(hashes)).bit_length()))
        self.slots = np.zeros(1 << (64 - int(self.shift)), np.int32)
        left, at = np.arange(len(hashes)), (mix(self.hashes) >> self.shift).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.slots[at] == 0)
            got = free[np.unique(at[free], return_index=True)[1]]
            self.slots[at[got]] = left[got] + 1
            stay = np.ones(len(left), bool)
            stay[got] = False
            left, at = left[stay], (at[stay] + 1) & (len(self.slots) - 1)

    def of(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        out, left, at = np.full(len(h), -1), np.arange(len(h)), (mix(h) >> self.shift).astype(np.int64)
        while len(left):
            found = self.slots[at] - 1
            right = (found >= 0) & (self.hashes[found] == h[left]) if len(self.hashes) else found >= 0
            out[left[right]] = found[right]
            on = ~right & (found >= 0)
            left, at = left[on], (at[on] + 1) & (len(self.slots) - 1)
        return out


def level(n):
    """Which step of the histogram a count is in: eight to each doubling."""
    return F.floor(8 * F.log2(n)).cast("int")


def vocabulary(counts: DataFrame) -> Vocabulary:
    got = counts.agg(F.sum("n"), F.count("*")).first()
    total, kinds = int(got[0] or 0), int(got[1])
    least, many = 0, kinds
    for r in counts.groupBy(level("n").alias("level")).count().orderBy("level").collect():
        if many <= HEAVY:
            break
        least, many = r.level + 1, many - r["count"]
    rows = counts.where(level("n") >= least).toArrow()  # HEAVY rows at most
    h, tail, n = (rows.column(k).to_numpy() for k in ("h", "tail", "n"))
    order = np.argsort(h)
    h, tail, n = h[order], tail[order], n[order]
    words = np.flatnonzero((tail >= 0) & (n >= LEAST))
    top = words[np.lexsort((h[words], -n[words]))[: UNITS - TAILS - 1]]
    sums = {r.tail: (r.n, r.k) for r in counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()}
    # The end, the words and the tails, before they are ordered.
    mass = np.concatenate([[sums.get(-1, (0, 0))[0]], n[top], np.zeros(TAILS)]).astype(float)
    smooth = np.zeros(TAILS)
    for t in range(TAILS):
        own = top[tail[top] == t]
        s, k = sums.get(t, (0, 0))
        mass[1 + len(top) + t] = s - n[own].sum()
        smooth[t] = mass[1 + len(top) + t] + 0.1 * (k - len(own) + 1)  # one more for the unknown word
    falling = np.argsort(-mass, kind="stable")
    unit = np.empty(len(mass), np.int64)
    unit[falling] = np.arange(len(mass))
    ends = np.flatnonzero(tail < 0)
    of_heavy = unit[1 + len(top) + np.maximum(tail, 0)]
    of_heavy[top], of_heavy[ends] = unit[1 : 1 + len(top)], unit[0]
    within = np.zeros(len(mass))
    within[unit[1 + len(top) :]] = np.log10(smooth)
    mass = mass[falling] + 0.1
    # Classes: units of near frequency, each with the same sum of the roots of their counts.
    roots = np.cumsum(np.sqrt(mass))
    cls = np.minimum((roots / roots[-1] * math.isqrt(len(mass))).astype(np.int64), math.isqrt(len(mass)) - 1)
    first = np.flatnonzero(np.append(True, cls[1:] != cls[:-1]))
    return Vocabulary(total, kinds, h, n.astype(np.int64), of_heavy.astype(np.uint16), least, int(unit[0]), unit[1 + len(top) :], within, mass, np.append(first, len(mass)))


class Bilinear:
    """The parameters: `rows` has C1 (and its row of the start), C2 and S below one another, `classes` has R; each row ends in its bias, and `seen` holds each row's mean squared gradient so far."""

    def __init__(self, v: Vocabulary, rows: np.ndarray, seen: np.ndarray, classes: np.ndarray, seen_classes: np.ndarray) -> None:
        self.v, self.rows, self.seen, self.classes, self.seen_classes = v, rows, seen, classes, seen_classes
        n = v.units + 1
        self.c1, self.c2, self.s, self.bias = rows[:n, :DIMS], rows[n : 2 * n, :DIMS], rows[2 * n :, :DIMS], rows[2 * n :, DIMS]
        self.r, self.class_bias = classes[:, :DIMS], classes[:, DIMS]

    @classmethod
    def start(cls, v: Vocabulary) -> "Bilinear":
        n = v.units
        rows = np.zeros((3 * n + 2, DIMS + 1), np.float32)
        rows[: 2 * n + 2, :DIMS] = np.random.default_rng(5).normal(0, 0.1, (2 * n + 2, DIMS))
        sums = np.add.reduceat(v.mass, v.first[:-1])
        rows[2 * n + 2 :, DIMS] = np.log(v.mass / sums[v.of])
        classes = np.zeros((v.classes, DIMS + 1), np.float32)
        classes[:, DIMS] = np.log(sums / sums.sum())
        return cls(v, rows, np.full(len(rows), 1e-6, np.float32), classes, np.full(len(classes), 1e-6, np.float32))

    def copy(self) -> "Bilinear":
        return Bilinear(self.v, self.rows.copy(), self.seen.copy(), self.classes.copy(), self.seen_classes.copy())

    def _add(self, base: int, at: np.ndarray, g: np.ndarray) -> None:
        """Adds the gradients g to the rows base + at, summed where a row occurs several times; a row's step falls with its gradients so far."""
        order = np.argsort(at.astype(np.uint16), kind="stable")  # a radix sort at this width
        s = at[order]
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        g, s = np.add.reduceat(g[order], first), base + s[first]
        self.seen[s] += np.einsum("ij,ij->i", g, g) / g.shape[1]
        self.rows[s] += (RATE / np.sqrt(self.seen[s]))[:, None] * g

    def step(self, a: np.ndarray, b: np.ndarray, w: np.ndarray, rng: np.random.Generator, noise: "Noise") -> None:
        """One step of noise-contrastive estimation on units w after a (nearest) and b: first which class, then which unit of the class."""
        n, units = len(w), self.v.units
        q = self.rows[a] + self.rows[units + 1 + b]
        q[:, DIMS] = 1
        cls = noise.of[w]
        drawn, often = np.unique(np.minimum(np.searchsorted(noise.class_sums, rng.random(NOISE) * noise.class_sums[-1], "right"), len(self.classes) - 1), return_counts=True)
        theirs = self.classes[drawn]
        e = -often.astype(np.float32) / (1 + np.exp(np.clip(noise.class_log[drawn] + np.float32(math.log(NOISE)) - q @ theirs.T, -30, 30)))
        own = self.classes[cls]
        p = 1 / (1 + np.exp(np.clip(np.einsum("ij,ij->i", q, own) - noise.class_log[cls] - np.float32(math.log(NOISE)), -30, 30)))
        dq = e @ theirs + p[:, None] * own
        order = np.argsort(cls, kind="stable")
        s = cls[order]
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        g = np.zeros_like(self.classes)
        g[s[first]] = np.add.reduceat((p[:, None] * q)[order], first)
        g[drawn] += e.T @ q
        # Units of the class, if it has several.
        words = np.concatenate([w, *(np.searchsorted(noise.sums, noise.low[cls] + rng.random(n) * noise.span[cls], "right").astype(w.dtype) for _ in range(WITHIN))])
        s = self.rows[2 * units + 2 + words].reshape(1 + WITHIN, n, -1)
        x = np.einsum("ij,kij->ki", q, s) - noise.log[words].reshape(1 + WITHIN, n) - np.float32(math.log(WITHIN))
        x[0] = 1 / (1 + np.exp(np.clip(x[0], -30, 30)))
        x[1:] = -1 / (1 + np.exp(np.clip(-x[1:], -30, 30)))
        x *= noise.several[cls]
        dq += np.einsum("ki,kij->ij", x, s)
        x /= n
        np.multiply(q, x[:, :, None], out=s)
        self._add(2 * units + 2, words, s.reshape(-1, DIMS + 1))
        g /= n
        self.seen_classes += np.einsum("ij,ij->i", g, g) / g.shape[1]
        self.classes += (RATE / np.sqrt(self.seen_classes))[:, None] * g
        dq /= n
        dq[:, DIMS] = 0  # contexts have no bias
        self._add(0, a, dq)
        self._add(units + 1, b, dq)

    def log_p(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Natural log of P(unit | a, b), normalised over all classes and all units of the class."""
        cls, units = self.v.of[w], self.v.units
        q = self.rows[a] + self.rows[units + 1 + b]
        q[:, DIMS] = 1
        out = np.empty(len(w))
        for i in range(0, len(w), 1024):
            z = q[i : i + 1024] @ self.classes.T
            at = z[np.arange(len(z)), cls[i : i + 1024]]
            out[i : i + 1024] = at - _log_sum(z)
        order = np.argsort(cls, kind="stable")
        for same in np.split(order, np.flatnonzero(np.diff(cls[order])) + 1):
            lo, hi = self.v.first[cls[same[0]]], self.v.first[cls[same[0]] + 1]
            step = max(64, 200_000 // (hi - lo)) if hi - lo > 1 else len(same)
            for i in range(0, len(same), step) if hi - lo > 1 else ():
                rows = same[i : i + step]
                z = q[rows] @ self.rows[2 * units + 2 + lo : 2 * units + 2 + hi].T
                at = z[np.arange(len(rows)), w[rows] - lo]
                out[rows] += at - _log_sum(z)
        return out


def _log_sum(z: np.ndarray) -> np.ndarray:
    """log of the sum of exp over each row of z, which is overwritten."""
    top = z.max()  # one for all rows, unless they are far apart
    rows = None if top - z.min() < 60 else z.max(1, keepdims=True)
    z -= top if rows is None else rows
    np.exp(z, out=z)
    return np.log(z @ np.ones(z.shape[1], np.float32)) + (top if rows is None else rows[:, 0])


class Noise:
    """What the noise samples are drawn from: the smoothed counts."""

    def __init__(self, v: Vocabulary) -> None:
        self.of, sums = v.of.astype(np.uint16), np.add.reduceat(v.mass, v.first[:-1])
        self.class_sums, self.class_log = np.cumsum(sums), np.log(sums / sums.sum()).astype(np.float32)
        self.sums = np.cumsum(v.mass)
        self.low = np.append(0.0, self.sums[v.first[1:-1] - 1])
        self.span = (self.sums[v.first[1:] - 1] - self.low) * (1 - 1e-9)
        self.log = np.log(v.mass / sums[self.of]).astype(np.float32)
        self.several = (np.diff(v.first) > 1).astype(np.float32)


def _contexts(c: np.ndarray, starts: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """The units before and two before each; `before` where a text starts."""
    a, b = np.empty_like(c), np.empty_like(c)
    a[1:], b[2:] = c[:-1], c[:-2]
    b[:2] = before
    a[starts] = before
    b[np.minimum(starts + 1, len(c) - 1)] = before
    b[starts] = before
    return a, b


def encode(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """doc_id, row, train, n_tokens, known and base (over the frequent words), codes (16-bit units), tail (log10 of the shares within tails) and the other words (hs) with their counts (ns), from docs (doc_id, text, train)."""
    log_n = math.log10(v.total + 0.1 * (v.kinds + 1))

    def run(batches):
        places, log_c = Places(v.heavy), np.append(0.0, np.log10(v.n + 0.1)) - log_n  # by place plus one
        share = np.where(v.within[v.unit] > 0, log_c[1:] + log_n - v.within[v.unit], 0.0)
        for b in batches:
            for part in slices(b, 1, rows=256):
                tokens: list[bytes] = []
                ends = []
                for t in part.column(1).to_pylist():
                    tokens += lower_words(t)
                    tokens.append(END)
                    ends.append(len(tokens))
                ends = np.array(ends)
                starts = np.append(0, ends[:-1])
                place = places.of(hashes(tokens))
                known = place >= 0
                unit, tail = np.zeros(len(tokens), np.uint16), np.zeros(len(tokens))
                unit[known], tail[known] = v.unit[place[known]], share[place[known]]
                left: list[Counter] = [Counter() for _ in starts]
                rare = np.flatnonzero(~known)
                if len(rare):
                    words = [tokens[i] for i in rare.tolist()]
                    for w, doc in zip(words, np.searchsorted(ends, rare, "right").tolist(), strict=True):
                        left[doc][w] += 1
                    unit[rare] = np.where(np.array([w == END for w in words]), v.end, v.tail[tails_of(words)])
                    tail[rare] = -v.within[unit[rare]]
                arrays = [part.column(0), part.column(2), pa.array(ends - starts), pa.array(np.add.reduceat(known.astype(np.int64), starts)), pa.array(np.add.reduceat(log_c[place + 1], starts)), pa.array(np.add.reduceat(tail, starts))]
                arrays += [pa.array([unit[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary()), pa.array([hashes(list(c)).view(np.int64) for c in left], pa.list_(pa.int64())), pa.array([list(c.values()) for c in left], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "train", "n_tokens", "known", "base", "tail", "codes", "hs", "ns"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    coded = docs.select("doc_id", "text", "train").mapInArrow(run, f"doc_id {kind}, train boolean, n_tokens long, known long, base double, tail double, codes binary, hs array<long>, ns array<int>")
    return coded.withColumn("row", F.monotonically_increasing_id())


#: Rows of parameters that are summed together, and shards.
CHUNK, FAN = 1024, 64


def train(coded: DataFrame, v: Vocabulary, *, rounds: int = ROUNDS, epochs: int = EPOCHS, shard: int = SHARD) -> Bilinear:
    """Parameters after so many rounds over the training rows of encode()."""
    model = Bilinear.start(v)
    if not v.total:
        model.rows[:], model.classes[:] = 0, 0
        return model
    shards = max(1, math.ceil(v.total / (rounds * shard)))
    at = F.xxhash64("doc_id", "codes", F.lit(23))
    dealt = coded.where("train").select("codes", "doc_id", at.alias("h"), F.pmod(at, F.lit(rounds)).alias("round"), F.pmod(F.xxhash64("doc_id", "codes", F.lit(29)), F.lit(shards)).cast("int").alias("shard"))
    for turn in range(rounds):

        def run(batches, start=model, turn=turn):
            held, held_n, now, part = [], 0, None, 0
            noise = Noise(v)

            def learn():
                """The steps on what is held; yields the rows that changed, in chunks."""
                own, rng = start.copy(), np.random.default_rng((turn, now, part))
                starts = np.cumsum([0] + [len(c) for c in held[:-1]])
                w = np.concatenate(held).astype(np.int32)
                a, b = _contexts(w, starts, v.units)
                for _ in range(epochs):
                    order = rng.permutation(len(w))
                    for i in range(0, len(w), BATCH):
                        x = order[i : i + BATCH]
                        own.step(a[x], b[x], w[x], rng, noise)
                parts = []
                for k, (rows, seen, old, before) in enumerate(((own.rows, own.seen, start.rows, start.seen), (own.classes, own.seen_classes, start.classes, start.seen_classes))):
                    use = (seen - before).astype(float)
                    at = np.flatnonzero(use > 0)
                    x = np.concatenate([rows[at] - old[at], use[at, None], np.ones((len(at), 1))], 1) * use[at, None]
                    chunks = np.full(len(at), -1) if k else at // CHUNK
                    parts += [(int(c), at[p].astype(np.int32).tobytes(), x[p].astype(np.float32).tobytes()) for c in np.unique(chunks) for p in [chunks == c]]
                return pa.RecordBatch.from_arrays([pa.array([now] * len(parts), pa.int32()), *(pa.array([r[i] for r in parts], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary())))], names=["shard", "chunk", "at", "v"])

            for batch in batches:
                for codes, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if held and (s != now or held_n >= 2 * shard):  # rows without end in one shard make several
                        yield learn()
                        held, held_n, part = [], 0, part + 1 if s == now else 0
                    now = s
                    held.append(np.frombuffer(codes, np.uint16))
                    held_n += len(held[-1])
            if held:
                yield learn()

        own = dealt.where(F.col("round") == turn).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "doc_id", "h").select("codes", "shard")
        sums, left = own.mapInArrow(run, "shard int, chunk int, at binary, v binary"), shards
        while left > FAN:  # a group never holds more than about FAN shards
            left = math.ceil(left / FAN)
            sums = _summed(sums.withColumn("shard", F.pmod("shard", F.lit(left)).cast("int")))
        model = model.copy()
        for r in _summed(sums.withColumn("shard", F.lit(0))).collect():
            at, x = np.frombuffer(r.at, np.int32), np.frombuffer(r.v, np.float32).reshape(-1, DIMS + 3)
            x = (x[:, :-1] / np.maximum(x[:, -1:], 1e-300)).astype(np.float32)
            rows, seen = (model.classes, model.seen_classes) if r.chunk < 0 else (model.rows, model.seen)
            rows[at] += x[:, :-1]
            seen[at] += x[:, -1]
    return model


def _summed(parts: DataFrame) -> DataFrame:
    """The sums by row over each shard and chunk of (shard, chunk, at, v)."""

    def add(t: pa.Table) -> pa.Table:
        at = np.concatenate([np.frombuffer(x, np.int32) for x in t.column("at").to_pylist()])
        x = np.concatenate([np.frombuffer(v, np.float32) for v in t.column("v").to_pylist()]).reshape(len(at), -1).astype(float)
        order = np.argsort(at, kind="stable")
        at, x = at[order], x[order]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        return pa.table({"shard": t.column("shard").slice(0, 1), "chunk": t.column("chunk").slice(0, 1), "at": pa.array([at[first].tobytes()], pa.binary()), "v": pa.array([np.add.reduceat(x, first).astype(np.float32).tobytes()], pa.binary())})

    return parts.groupBy("shard", "chunk").applyInArrow(add, "shard int, chunk int, at binary, v binary")


def score(coded: DataFrame, counts: DataFrame, v: Vocabulary, model: Bilinear) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score for each row of encode()."""

    def run(batches):
        for b in batches:
            for part in slices(b, 2, rows=256):
                own = [np.frombuffer(x, np.uint16) for x in part.column(2).to_pylist()]
                starts = np.cumsum([0] + [len(x) for x in own[:-1]])
                w = np.concatenate(own).astype(np.int64)
                lp = model.log_p(*_contexts(w, starts, v.units), w) / math.log(10)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.add.reduceat(lp, starts))], names=["row", "tail", "lp"])

    lp = coded.select("row", "tail", "codes").mapInArrow(run, "row long, tail double, lp double").select("row", (F.col("lp") + F.col("tail")).alias("lp"))
    rare = coded.select("row", F.explode(F.arrays_zip("hs", "ns")).alias("x")).select("row", F.col("x.hs").alias("h"), F.col("x.ns").alias("k"))
    rare = rare.join(counts.where(level("n") < v.level).select("h", "n"), "h", "left")
    rare = rare.groupBy("row").agg(F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1))).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("also"))
    more = F.coalesce("more", F.lit(0.0))
    out = coded.select("doc_id", "row", "train", "n_tokens", "known", "base").join(lp, "row").join(rare, "row", "left")
    return out.select("doc_id", "train", "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"), (F.col("base") + more).alias("base_score"), (F.col("lp") + more).alias("score"))


def fit_and_score(docs: DataFrame, *, held_out: tuple[int, int] = (10, 0), **params) -> DataFrame:
    """Learns from the documents whose crc32(doc_id) modulo held_out[0] is not held_out[1], and scores all."""
    remainder = bucket_of("doc_id", held_out[0]) == held_out[1]
    split = docs.select("doc_id", "text", (~remainder).alias("train"))
    counts = materialise(word_counts(split.where("train")), "counts")
    v = vocabulary(counts)
    coded = materialise(encode(split, v), "coded")
    out = score(coded, counts, v, train(coded, v, **params))
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(v.total).cast("long").alias("train_tokens"), "base_score", "score")
