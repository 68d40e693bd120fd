"""Quality rules by distribution divergence.

A document's character-class histogram and its common-word histogram are
compared with references of each language by Jensen-Shannon distance, the root of
the divergence in bits.
The references are sums over all documents that name a language; the common
words of a language are its most frequent ones over all documents.

Nulls and edge cases: a null text has no words (all counts 0, base_failed). A
document of no reference language (no lang anywhere in the table) is judged by
the base rules alone. Distances count only from min_chars characters and
min_words words on; below, they are null. Repeated rows are judged each on its
own. Extra columns are ignored, or passed through by keep().
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import annotate, slices

#: Character classes of the first histogram.
CLASSES = ("lower", "upper", "digit", "letter beyond ASCII", "white space", "sentence mark", "symbol", "other")
SYMBOLS = b"#*$%&|<>"
#: Distances beyond these reject; ordinary prose of such lengths stays well below either.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.32, 0.5
MIN_CHARS, MIN_WORDS, COMMON = 200, 100, 64


def _class_table() -> bytes:
    t = bytearray(7 for _ in range(256))
    for b in range(256):
        c = chr(b)
        if 97 <= b <= 122:
            t[b] = 0
        elif 65 <= b <= 90:
            t[b] = 1
        elif 48 <= b <= 57:
            t[b] = 2
        elif b >= 0xC0:
            t[b] = 3
        elif b >= 0x80:
            t[b] = 8  # the further bytes of a character: not counted
        elif b in b" \t\n\r\x0b\x0c":
            t[b] = 4
        elif c in ".,;:!?'\"-()":
            t[b] = 5
        elif b in SYMBOLS:
            t[b] = 6
    return bytes(t)


_TABLE = _class_table()


def char_histogram(raw: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(raw.translate(_TABLE), np.uint8), minlength=9)[:8]


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (root of bits) between each row of p (counts) and q (one histogram)."""
    p = p / np.maximum(p.sum(1, keepdims=True), 1e-300)
    q = q / max(q.sum(), 1e-300)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    white = len(raw) - sum(map(len, words))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split()] if b"\n" in raw else []
    dup = len(lines) - len(set(lines))
    repeat = 0
    if n >= 4:
        ids: dict[bytes, int] = {}
        w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
        if len(ids) < 1 << 21:
            key = (w[:-2] << 42) | (w[1:-1] << 21) | w[2:]
        else:  # over two million different words: pair numbers first, so that nothing overflows
            key = np.unique(w[:-2] * len(ids) + w[1:-1], return_inverse=True)[1] * len(ids) + w[2:]
        order = np.argsort(key, kind="stable")
        s = key[order]
        same = s[1:] == s[:-1]
        if same.any():
            twice = np.zeros(len(s), bool)
            twice[1:] |= same
            twice[:-1] |= same
            at = order[twice]
            covered = np.zeros(n, bool)
            for j in range(3):
                covered[at + j] = True
            repeat = int(covered.sum())
    return n, len(text) - white, symbols, dup, repeat


def references(docs: DataFrame, common: int = COMMON) -> dict[str, tuple[np.ndarray, dict[bytes, int]]]:
    """For each lang its character-class totals and its most common words with their counts, and the count of all words under None.

    All documents are counted. The driver gets `common` words and nine sums for each language.
    """

    def count(batches):
        words: dict[str, Counter] = {}
        chars: dict[str, np.ndarray] = {}

        def rows():
            out = [(k, w, n) for k, c in words.items() for w, n in c.items()]
            out += [(k, b" %d" % i, int(n)) for k, h in chars.items() for i, n in enumerate(h)]  # no word has a blank
            out += [(k, b"", sum(c.values())) for k, c in words.items()]
            words.clear()
            chars.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.string(), pa.binary(), pa.int64()), strict=True)], names=["lang", "word", "n"])

        for b in batches:
            for part in slices(b, 1):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    words.setdefault(lang, Counter()).update(raw.lower().split())
                    chars[lang] = chars.get(lang, 0) + char_histogram(raw)
                if sum(map(len, words.values())) > 300_000:
                    yield rows()
        if words:
            yield rows()

    counts = docs.where(F.col("lang").isNotNull()).select("lang", "text").mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # Ranks within a language come from two levels: first within a part of the words, then among the parts' leaders.
    part = counts.withColumn("special", F.length("word").isin(0, 2) & ((F.length("word") == 0) | (F.substring("word", 1, 1) == F.lit(b" "))))
    part = part.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(64)))
    order = (F.col("n").desc(), F.col("word"))
    part = part.withColumn("r", F.row_number().over(W.partitionBy("lang", "special", "part").orderBy(*order))).where(F.col("r") <= common)
    top = part.withColumn("r", F.row_number().over(W.partitionBy("lang", "special").orderBy(*order))).where(F.col("special") | (F.col("r") <= common))
    out: dict[str, tuple[np.ndarray, dict]] = {}
    for r in top.select("lang", "word", "n").orderBy("lang", F.col("n").desc(), "word").collect():
        chars, words = out.setdefault(r.lang, (np.zeros(8), {}))
        w = bytes(r.word)
        if w[:1] == b" ":
            chars[int(w)] = r.n
        else:
            words[w or None] = r.n
    return out


FIELDS = [
    *(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("char_distance", T.DoubleType()),
    T.StructField("word_distance", T.DoubleType()),
]


def _scorer(refs, max_char: float, max_word: float, min_chars: int, min_words: int):
    langs = sorted(refs)
    vocab: dict[bytes, int] = {}
    for k in langs:
        for w in refs[k][1]:
            if w is not None:
                vocab.setdefault(w, len(vocab))
    cols = [np.array([vocab[w] for w in refs[k][1] if w is not None], np.int64) for k in langs]
    word_refs = []
    for k in langs:
        c = np.array([n for w, n in refs[k][1].items() if w is not None], float)
        word_refs.append(np.append(c, max(0.0, refs[k][1].get(None, 0) - c.sum())))
    chars = [refs[k][0] for k in langs]
    none = len(vocab)

    def score(texts: list) -> list[pa.Array]:
        base = [base_counts(t) for t in texts]
        n, size = np.array([b[0] for b in base]), np.array([len(t or "") for t in texts])
        repeat = np.array([b[4] for b in base])
        failed = (n < 50) | (100 * repeat > 50 * n)
        jc = jw = np.full(len(texts), np.inf)
        if langs:
            raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            ch = np.stack([char_histogram(r) for r in raws]).astype(float)
            wh = np.stack([np.bincount(np.fromiter((vocab.get(w, none) for w in r.lower().split()), np.int64), minlength=none + 1) for r in raws]).astype(float)
            both = []
            for c, wr, at in zip(chars, word_refs, cols, strict=True):
                own = wh[:, at]
                both.append((distance(ch, c), distance(np.column_stack([own, wh.sum(1) - own.sum(1)]), wr)))
            sums = np.stack([a + b for a, b in both])
            best = sums.argmin(0)  # the language that it is nearest to, whatever lang says
            jc = np.stack([a for a, _ in both])[best, np.arange(len(texts))]
            jw = np.stack([b for _, b in both])[best, np.arange(len(texts))]
        use_c, use_w = (size >= min_chars) & np.isfinite(jc), (n >= min_words) & np.isfinite(jw)
        bad = (use_c & (jc > max_char)) | (use_w & (jw > max_word))
        return [
            *(pa.array([b[i] for b in base], pa.int64()) for i in range(5)),
            pa.array(failed),
            pa.array(~(failed | bad)),
            pa.array(jc, pa.float64(), mask=~use_c),
            pa.array(jw, pa.float64(), mask=~use_w),
        ]

    return score


def judge(docs: DataFrame, refs: dict | None = None, *, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id and the columns of FIELDS for each row of docs (doc_id, text, lang). refs: as references() gives them, else from docs."""
    refs = references(docs) if refs is None else refs
    out, names = annotate(docs.select("doc_id", "text"), "text", _scorer(refs, max_char, max_word, min_chars, min_words), FIELDS)
    return out.select("doc_id", *(F.col(n).alias(f.name) for n, f in zip(names, FIELDS, strict=True)))


def keep(docs: DataFrame, **params) -> DataFrame:
    """The rows of docs that judge() keeps, with all their columns and in one pass over them."""
    score = _scorer(references(docs), *(params.get(k, v) for k, v in (("max_char", MAX_CHAR_DISTANCE), ("max_word", MAX_WORD_DISTANCE), ("min_chars", MIN_CHARS), ("min_words", MIN_WORDS))))
    out, names = annotate(docs, "text", lambda texts: [score(texts)[6]], [FIELDS[6]])
    return out.where(F.col(names[0])).select(*docs.columns)
