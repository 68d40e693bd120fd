"""Filter interaction and source divergence against plain Python, with odd rows."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from caudal.llm import filter_audit, source_audit

SCHEMA = "doc_id long, text string, lang string, source string"


def words(rng, n, letters="abcdefgh", most=3):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(300):
        text = words(rng, rng.choice([5, 150, 210, 400]), most=rng.choice([1, 6]))
        text = rng.choice([text, text.upper(), text + " #1", text.title(), "Árbol " + text])
        out.append((i, text, rng.choice(["en", "es", None]), rng.choice(["a", "a", "a", "b", "c", None])))
    for i in range(300, 360):  # a large group of copies, over sources
        out.append((i, out[17][1], "en", rng.choice(["a", "b"])))
    out += [(400, None, None, None), (401, "", "en", ""), (402, " \n", "", "b"), (None, out[17][1], "en", "a"), (None, out[18][1], "en", "c"), (403, "x" * 50_000, "es", "a")]
    out += [out[3], out[3], (5, out[6][1], "en", "b"), (404, words(rng, 20_000), "en", "é"), (-1, "only one", "zz", "d")]
    return out


def clash(df):
    return df.withColumns({"part": F.lit("x"), "mask": F.lit(1), "h1": F.lit(2), "n": F.lit(3), "term": F.lit(4), "first": F.lit(5), "good": F.lit(6), "block": F.lit(7)})


# --- filters ------------------------------------------------------------------


def masks_of(rows):
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, _, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append([len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t]])
    return out


def brute_audit(rows, labels):
    good, toxic = ({i for i, *v in labels if v[k] == 1} for k in (0, 1))
    parts = defaultdict(list)
    for (i, _, _, source), fails in zip(rows, masks_of(rows), strict=True):
        parts[source or ""].append((fails, i in good and i is not None, i in toxic and i is not None))
    out = {}
    for part, docs in parts.items():
        removed_by = Counter()
        for p in permutations(range(5)):
            left = docs
            for step, f in enumerate(p, 1):
                gone = [d for d in left if d[0][f]]
                removed_by[f] += len(gone)
                left = [d for d in left if not d[0][f]]
                redundant = sum(d[0][f] and any(d[0][e] for e in p[: step - 1]) for d in docs)
                alone = sum(d[0][f] and sum(d[0]) == 1 for d in docs)
                out[part, "".join("ABCDE"[x] for x in p), step] = [len(left), len(gone), redundant, alone, sum(d[1] for d in gone), sum(d[2] for d in gone), f]
        for k, v in out.items():
            if k[0] == part:
                v[6] = removed_by[v[6]] if len(v) == 7 else v[6]
    return {k: tuple(v) for k, v in out.items()}


def test_filter_audit(spark, rows):
    labels = [(i, i % 3 == 0 and 1 or 0, int(i % 7 == 0)) for i in range(0, 400, 2)] + [(3, 1, None), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    want = brute_audit(rows, labels)
    df = clash(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = filter_audit.audit(df, clash(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).collect()
    assert len(got) == len(want) == 600 * len({r[3] or "" for r in rows})
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got} == want


def test_the_bloom_filter_clears_only_single_texts(spark, rows, monkeypatch):
    monkeypatch.setattr(filter_audit, "LEAST_BITS", 5)  # so small that it clears next to nothing: the result is the same
    df = spark.createDataFrame(rows, SCHEMA)
    seen = filter_audit.masks(df).cache()
    for bits in (5, 16):
        monkeypatch.setattr(filter_audit, "MOST_BITS", bits)
        repeats = filter_audit.Repeats(seen)
        texts = Counter(t or "" for _, t, *_ in rows)
        some = list(texts)
        hit = repeats.has(*filter_audit._hashes(some))
        assert all(h for t, h in zip(some, hit, strict=True) if texts[t] > 1)
        assert bits == 5 or (~hit).sum() > 0.9 * sum(n == 1 for n in texts.values())
        masked = Counter()
        for r in filter_audit.with_repeats(seen, df).collect():
            masked[r.doc_id, r.part, r.mask] += r.n
        assert masked == Counter((i, s or "", sum(f << k for k, f in enumerate(m))) for (i, _, _, s), m in zip(rows, masks_of(rows), strict=True))


def test_ids_as_texts_and_empty_tables(spark):
    labels = spark.createDataFrame([("b", 1, 0)], "doc_id string, quality int, toxic int")
    docs = spark.createDataFrame([("a", "same", "s"), ("b", "same", "s")], "doc_id string, text string, source string")
    last = filter_audit.audit(docs, labels).where("filter_order = 'EABCD' and step = 1").first()
    assert (last.removed, last.good_lost, last.unique_fails) == (1, 1, 0)
    none = docs.limit(0)
    assert filter_audit.audit(none, labels).collect() == []


# --- divergence -----------------------------------------------------------------


def brute_divergence(rows, min_docs, top):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    counts, df, groups = defaultdict(Counter), Counter(), defaultdict(set)
    for _, t, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
        counts[lang, source].update(found)
        df.update((lang, w) for w in set(found))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(w for k, w in df if k == lang and df[k, w] >= min_docs)
        v = len(kept)
        n = {s: sum(counts[lang, s][w] for w in kept) for s in sources}
        share = lambda c, total: 1 + (1_000_000_000 * (c + 5)) // (total + 5 * v)  # noqa: B023, E731
        for s in sources:
            p = {w: share(counts[lang, s][w], n[s]) for w in kept}
            pairs = sorted(((-sum(abs(p[w] - share(counts[lang, o][w], n[o])) for w in kept), o.encode()) for o in sources - {s}))
            out |= {(lang, s, "pair", o.decode(), -f, r) for r, (f, o) in enumerate(pairs, 1)}
            q = {w: share(sum(counts[lang, o][w] for o in sources), sum(n.values())) for w in kept}
            over = sorted((q[w] - p[w], w.encode()) for w in kept if counts[lang, s][w] > 0 and p[w] > q[w])
            out |= {(lang, s, "term", w.decode(), -f, r) for r, (f, w) in enumerate(over[:top], 1)}
    return out


@pytest.mark.parametrize("small", [False, True])
def test_source_divergence(spark, rows, monkeypatch, small):
    if small:  # many tiles and blocks
        monkeypatch.setattr(source_audit, "TILE", 5)
        monkeypatch.setattr(source_audit, "SOURCES", 2)
        monkeypatch.setattr(source_audit, "HELD", 50)
    df = clash(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = [tuple(r) for r in source_audit.audit(df, min_docs=20, top=7).select("lang", "source", "part", "item", "value", "rank").collect()]
    want = brute_divergence(rows, 20, 7)
    assert len(got) == len(set(got)) and set(got) == want
    assert {r[2] for r in want} == {"pair", "term"} and any(r[0] == "zz" for r in want) is False


def test_languages_without_kept_terms(spark):
    df = spark.createDataFrame([(1, "a b", "xx", "s"), (2, None, "xx", "t"), (3, "!!", None, None)], SCHEMA)
    assert sorted(tuple(r) for r in source_audit.audit(df).collect()) == [("xx", "s", "pair", "t", 0, 1), ("xx", "t", "pair", "s", 0, 1)]
    assert source_audit.audit(df.limit(0)).collect() == []


def test_quadtrees_of_many_sources():
    rng = np.random.default_rng(3)
    for n, m, cols, full in ((70, 30, 500, 0.02), (5, 90, 70, 0.5), (9, 9, 33, 0.0), (64, 1, 1, 1.0)):
        trees, dense = [], []
        for size in (n, m):
            counts = rng.integers(1, 10**12, (size, cols)) * (rng.random((size, cols)) < full)
            counts[:, : cols // 2] *= rng.random() < 0.7
            totals = counts.sum(1) + 5 * cols
            r, c = np.nonzero(counts)
            trees.append(source_audit.Quadtree(r, c, counts[r, c].astype(np.int64), totals.astype(np.int64), cols))
            dense.append(np.array([[1 + (10**9 * (int(x) + 5)) // int(t) for x in row] for row, t in zip(counts, totals, strict=True)], np.int64))
        want = np.abs(dense[0][:, None, :] - dense[1][None, :, :]).sum(2)
        assert (source_audit.pair_sums(*trees, False) == want).all()
        same = np.abs(dense[0][:, None, :] - dense[0][None, :, :]).sum(2)
        assert (np.triu(source_audit.pair_sums(trees[0], trees[0], True), 1) == np.triu(same, 1)).all()


def test_shares_of_large_counts(spark):
    cases = [(5, 5), (7, 3 * 10**14), (10**14 + 5, 3 * 10**14), (299_999_999_999_999, 3 * 10**14), (1, 1), (123_456_789, 987_654_321)]
    df = spark.createDataFrame(cases, "n long, total long")
    want = [1 + (10**9 * n) // t for n, t in cases]
    assert [r[0] for r in df.select(F.expr(source_audit.share("n", "total"))).collect()] == want
    assert source_audit.shares(np.array([n for n, _ in cases]), np.array([t for _, t in cases])).tolist() == want
