"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A document leaks an item if some run of its words is within an edit distance (in
words) of max_share of the item's length from the whole item.

1. Words are compared in lower case, without ASCII punctuation and symbols.
2. Windows worth a look follow from the q-gram lemma, which loses nothing: an
   item of L words within distance k shares at least L - 1 - 2k word pairs with
   the L + k words from the true start on.
3. Each such window, and the item, are embedded by CGK random walks: step j shows
   the current word and moves on by a random bit of (j, word), so a small edit
   distance becomes a small Hamming distance. Each of `repeats` walks samples
   `bits` places of the embedding; windows that agree with an item in all sampled
   places of a walk are candidates.
4. Candidates are verified by exact edit distance, with free ends.

The walks of long texts drift apart, so an item is cut into pieces of at most PIECE
words, as equal as may be; steps 2 and 3 are about pieces, and step 4 verifies the
whole item around a piece that agrees. Of a leaked item one piece at least is
within max_share of its own length, as the edits are shared out among the pieces.

At the threshold about 0.65 of a piece's places agree, by which it would be missed
with a probability of (1 - 0.65 ** bits) ** repeats: 8e-5 with the defaults. A window
is only held against pieces of which it has the pairs of step 2.

Items reach the tasks in blocks of at most about `block` (a proven bound for
what is broadcast), each block against all documents.

Nulls and edge cases: items or documents that are null or have no word match
nothing. Items of one word must occur as they are. Items of equal text are each
reported. Rows with a null doc_id are reported with it. Repeated rows are
reported each. Extra columns are ignored; keep() passes them through.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import M1, WordHashes, annotate, mix, slices

MAX_SHARE, REPEATS, BITS, BLOCK, PIECE = 0.2, 48, 4, 4000, 100
_PLAIN = bytes(b if (48 <= b <= 57 or 97 <= b <= 122 or b >= 0x80) else 32 for b in range(256))
_FILTER_BITS = 22
PAD = np.uint64(0)


def plain_words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


def pairs_of(w: np.ndarray) -> np.ndarray:
    return mix(w[:-1] * M1 + w[1:])


def edits(length: int, share: float) -> int:
    return int(math.floor(share * length + 1e-9))


@dataclass
class Items:
    ids: list[int]
    words: list[np.ndarray]
    share: float
    repeats: int
    bits: int
    of_pair: dict = field(default_factory=lambda: defaultdict(list))
    of_word: dict = field(default_factory=lambda: defaultdict(list))
    by_length: dict = field(default_factory=lambda: defaultdict(list))
    places: dict = field(default_factory=dict)
    tables: dict = field(default_factory=dict)
    different: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        #: Pieces: (item, words before it in the item), and their words.
        self.pieces: list[tuple[int, int]] = []
        self.part: list[np.ndarray] = []
        for i, w in enumerate(self.words):
            if len(w) == 1:
                self.of_word[int(w[0])].append(i)
                continue
            offset = 0
            for part in np.array_split(w, -(-len(w) // PIECE)):
                pairs = np.unique(pairs_of(part))
                self.seen[(pairs >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
                for p in pairs.tolist():
                    self.of_pair[p].append(len(self.pieces))
                self.by_length[len(part)].append(len(self.pieces))
                self.pieces.append((i, offset))
                self.part.append(part)
                offset += len(part)
        #: For groups of near lengths: the fewest pairs, and the span they are in.
        self.coarse, lengths = [], sorted(self.by_length)
        while lengths:
            group = [x for x in lengths if x <= 1.3 * lengths[0] + 1]
            lengths = lengths[len(group) :]
            self.coarse.append((min(self.need(x) for x in group), max(x + edits(x, self.share) for x in group)))

    def need(self, length: int) -> int:
        """Fewest positions whose pair is one of the piece's; a repeated pair counts at each."""
        return max(1, length - 1 - 2 * edits(length, self.share))

    def kinds(self, u: int) -> int:
        """Fewest different pairs of piece u that the span must show: an edit takes two of them at most."""
        if u not in self.different:
            self.different[u] = max(1, len(set(pairs_of(self.part[u]).tolist())) - 2 * edits(len(self.part[u]), self.share))
        return self.different[u]

    def table(self, length: int) -> dict[int, list[int]]:
        """The pieces of that length by the sampled places of each walk; made when first needed."""
        if length not in self.tables:
            rng = np.random.default_rng(1000 + length)
            steps, k = 3 * length, min(self.bits, 3 * length)
            sampled = np.zeros((steps, self.repeats), bool)
            for r in range(self.repeats):
                sampled[rng.choice(steps, k, replace=False), r] = True
            self.places[length] = [np.flatnonzero(x) for x in sampled]
            own = self.by_length[length]
            t: dict[int, list[int]] = defaultdict(list)
            for keys in self.walk(np.concatenate([self.part[u] for u in own]), np.arange(len(own)) * length, length):
                for u, key in zip(own, keys.tolist(), strict=True):
                    t[key].append(u)
            self.tables[length] = t
        return self.tables[length]

    def walk(self, w: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """For each repeat and each window w[start : start + length] one number from the sampled places of its embedding."""
        n = self.repeats
        at = np.zeros((n, len(starts)), np.int64)
        key = np.repeat(mix(np.arange(1, n + 1, dtype=np.uint64))[:, None], len(starts), 1)
        seeds = mix(np.arange(3 * length * n, dtype=np.uint64) + np.uint64(1_000_003)).reshape(-1, n, 1)
        w = np.concatenate([w, np.full(length + 1, PAD)])
        for j, places in enumerate(self.places[length]):
            word = np.where(at < length, w[starts + np.minimum(at, length)], PAD)
            if len(places):
                key[places] = mix(key[places] * M1 + word[places])
            at += ((word ^ seeds[j]) * M1 >> np.uint64(63)).astype(np.int64)
        return key


def several(starts: list[int], at: list[int], pairs: list[int], span: int, need: int) -> set[int]:
    """Those of the sorted starts whose span holds so many different pairs; pairs[i] is at position at[i]."""
    out: set[int] = set()
    inside: dict[int, int] = {}
    lo = hi = 0
    for s in starts:
        while hi < len(at) and at[hi] < s + span:
            inside[pairs[hi]] = inside.get(pairs[hi], 0) + 1
            hi += 1
        while lo < hi and at[lo] < s:
            left = inside[pairs[lo]] - 1
            if left:
                inside[pairs[lo]] = left
            else:
                del inside[pairs[lo]]
            lo += 1
        if len(inside) >= need:
            out.add(s)
    return out


def fit(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance between item and any run of text, and where such a run ends."""
    row = np.zeros(len(text) + 1, np.int64)
    steps = np.arange(len(text) + 1)
    for i, w in enumerate(item, 1):
        best = np.minimum(row[1:] + 1, row[:-1] + (text != w))
        new = np.concatenate([[i], best]) - steps
        row = np.minimum.accumulate(new) + steps
    return int(row.min()), int(row.argmin())


def leaks(w: np.ndarray, items: Items) -> dict[int, tuple[int, int]]:
    """Of a document's word hashes: for each leaked item (by position in items) its least distance and the window's first word."""
    found: dict[int, tuple[int, int]] = {}
    if items.of_word and len(w):
        for p, x in enumerate(w.tolist()):
            for i in items.of_word.get(x, ()):
                found.setdefault(i, (0, p))
    if len(w) < 2 or not items.coarse:
        return found
    pairs = pairs_of(w)
    hit = items.seen[(pairs >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
    total = np.concatenate([[0], np.cumsum(hit)])
    if not any(total[-1] >= c and (total[np.minimum(np.arange(len(total)) + span, len(total) - 1)] - total >= c).any() for c, span in items.coarse):
        return found
    places: dict[int, list[int]] = defaultdict(list)
    for p in np.flatnonzero(hit).tolist():
        for u in items.of_pair.get(int(pairs[p]), ()):
            places[u].append(p)
    windows: dict[int, set[int]] = {}
    lengths: dict[int, set[int]] = defaultdict(set)
    for u, at in places.items():
        length = len(items.part[u])
        need, k = items.need(length), edits(length, items.share)
        if len(at) < need:
            continue
        a = np.array(at)
        first, last = a[: len(a) - need + 1], a[need - 1 :]
        close = last - first < length + k  # the span holds that many pairs of the piece
        own: set[int] = set()
        for f, t in zip(first[close].tolist(), last[close].tolist(), strict=True):
            own.update(range(max(0, t - length - k + 1), f + 1))
        own = several(sorted(own), at, [int(pairs[p]) for p in at], length + k, items.kinds(u))
        if own:
            windows[u] = own
            lengths[length] |= own
    tried: set[tuple[int, int]] = set()
    for length, starts in lengths.items():
        s = np.array(sorted(starts))
        table = items.table(length)
        for part in range(0, len(s), 2048):
            keys = items.walk(w, s[part : part + 2048], length)
            for start, column in zip(s[part : part + 2048].tolist(), keys.T.tolist(), strict=True):
                for u in {u for key in column for u in table.get(key, ()) if start in windows.get(u, ())}:
                    i, offset = items.pieces[u]
                    item = items.words[i]
                    k, begin = edits(len(item), items.share), start - offset  # about where the item begins: within k of it
                    if (i, begin // max(1, k)) in tried or found.get(i, (1,))[0] == 0:
                        continue
                    tried.add((i, begin // max(1, k)))
                    slack = 2 * k if len(item) == length else 4 * k
                    base = max(0, begin - slack)
                    d, end = fit(item, w[base : max(0, begin + len(item) + slack + 1)])
                    hit = (d, start if len(item) == length else max(0, base + end - len(item)))
                    if d <= k and hit < found.get(i, (k + 1, 0)):
                        found[i] = hit
    return found


def blocks(benchmark: DataFrame, share: float, repeats: int, bits: int, block: int):
    """Items for the tasks, at most about `block` at a time."""
    own = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    n = max(1, math.ceil(own.count() / block))
    hashes = WordHashes()
    for b in range(n):
        rows = own.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b).select("item_id", "text").collect()
        got = sorted(((r.item_id, hashes.of(plain_words(r.text))) for r in rows), key=lambda x: x[0])
        got = [(i, w) for i, w in got if len(w)]
        yield Items([i for i, _ in got], [w for _, w in got], share, repeats, bits)


def find(docs: DataFrame, benchmark: DataFrame, *, max_share: float = MAX_SHARE, repeats: int = REPEATS, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """doc_id, item_id, distance (in words), item_words and start_word (about where, from 0) for each item that a row of docs (doc_id, text) leaks."""
    out, doc_kind, item_kind = None, docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    item_type = to_arrow_type(item_kind)
    for items in blocks(benchmark, max_share, repeats, bits, block):

        def run(batches, items=items):
            hashes = WordHashes()
            for b in (part for batch in batches for part in slices(batch, 1)):
                at, rows = [], []
                for k, text in enumerate(b.column(1).to_pylist()):
                    for i, (d, p) in leaks(hashes.of(plain_words(text)), items).items():
                        at.append(k)
                        rows.append((items.ids[i], d, len(items.words[i]), p))
                columns = [pa.array([r[j] for r in rows], t) for j, t in enumerate((item_type, pa.int32(), pa.int32(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *columns], names=["doc_id", "item_id", "distance", "item_words", "start_word"])

        part = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_kind.simpleString()}, item_id {item_kind.simpleString()}, distance int, item_words int, start_word int")
        out = part if out is None else out.union(part)
    return out


def keep(docs: DataFrame, benchmark: DataFrame, *, max_share: float = MAX_SHARE, repeats: int = REPEATS, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """The rows of docs that leak no item, with all columns, in one pass for each block of items."""
    columns = docs.columns
    for items in blocks(benchmark, max_share, repeats, bits, block):
        hashes = WordHashes()
        clean = lambda texts, items=items, hashes=hashes: [pa.array([not leaks(hashes.of(plain_words(t)), items) for t in texts], pa.bool_())]
        out, names = annotate(docs, "text", clean, [T.StructField("clean", T.BooleanType())])
        docs = out.where(F.col(names[0])).select(*columns)
    return docs


