"""The corpus operators against plain Python, and on nulls, empty tables, repeats and clashing columns."""

import math
import random
import re
import textwrap
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caudal.llm import decontam, html_extract, langid, licenses, lm, mixing, neardup, quality_knn, quality_rules, urls
from caudal.llm.common import WordHashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, k, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(k))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(60):
        out.append((i, words(rng, 90, "abcdefghij"), "xx", "s", 0))
    for i in range(60, 120):
        out.append((i, words(rng, 90, "klmnopqrst"), "yy", "s", 0))
    for i in range(120, 140):  # near copies of one text, by one word or more each
        w = out[3][1].split()
        for _ in range(1 + i % 4):
            w[rng.randrange(len(w))] = "zzz"
        out.append((i, " ".join(w), "xx", "s", 0))
    out += [(140, out[5][1], "xx", "s", 0), (141, out[5][1].upper(), "xx", "s", 0), (142, None, None, None, None), (143, "", "xx", "s", 0), (144, " \t\n", "xx", "s", 0), (145, "one two", "xx", "s", 0), (146, "ONE two", "xx", "s", 0), (None, "one two", "xx", "s", 0), (147, words(rng, 30_000), "xx", "s", 0)]
    out.append(out[7])  # a repeated row
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def clash(df):
    """Extra columns with names that the operators use."""
    return df.withColumns({"kept": F.lit("x"), "_c_kept": F.lit(1), "SCORE": F.lit(2), "rate": F.lit(3), "node": F.lit(4), "label": F.lit(5), "sig": F.lit(b"x")})


# --- near-duplicates --------------------------------------------------------


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t, *_ in rows if i is not None}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_match_brute_force(docs, rows):
    got = neardup.groups(clash(docs)).collect()
    want = brute_components(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_keep_one_of_each_group(docs, rows):
    kept = {r.doc_id for r in neardup.keep(clash(docs)).select("doc_id").collect()}
    assert kept == {i for i, (_, c) in brute_components(rows).items() if i == c} | {None}


def test_near_duplicates_across_blocks(spark, monkeypatch):
    """Chains near the threshold, with blocks of a few rows, so that the last step has to find links."""
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 4000)
    rng = random.Random(9)
    base = words(rng, 60).split()
    rows = []
    for i in range(70):
        w = list(base)
        for j in rng.sample(range(60), rng.randint(0, 6)):
            w[j] = f"q{rng.randrange(40)}"
        rows.append((i, " ".join(w), "xx", "s", 0))
    got = {r.doc_id: r.component_id for r in neardup.groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows).items()}


def test_pruning_limits_follow_the_posterior():
    for c, m in neardup.least_matches(0.75, 1e-7):
        tail = lambda k: sum(math.comb(c + 1, i) * 0.75**i * 0.25 ** (c + 1 - i) for i in range(k + 1))
        assert tail(m) >= 1e-7 and (m == 0 or tail(m - 1) < 1e-7)


# --- quality rules ----------------------------------------------------------


def brute_counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


def test_base_counts_match_brute_force():
    rng = random.Random(1)
    texts = [None, "", "a", "a b a b a b", "x y z\nx y z\n\nx y z", "é ü\x0bß # $|", "a\u00a0b\u2003c d", "a b c d a b c"]
    texts += ["".join(rng.choice("ab \n#é") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for t in texts:
        assert quality_rules.base_counts(t) == brute_counts(t), repr(t)


def test_quality_rules(docs, rows):
    out = quality_rules.judge(clash(docs)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[0].kept and by[100].kept and not by[142].kept and by[142].base_failed and by[142].n_words == 0
    assert quality_rules.keep(clash(docs)).count() == sum(r.kept for r in out)
    assert set(quality_rules.keep(clash(docs)).columns) == set(clash(docs).columns)


def test_quality_rules_reject_what_is_far_from_prose(spark, docs):
    rng = random.Random(8)
    odd = [(1000, words(rng, 120, "#*%&|"), "xx", "s", 0), (1001, words(rng, 120).upper() + "!!" * 50, "xx", "s", 0)]
    got = {r.doc_id: r for r in quality_rules.judge(docs.union(spark.createDataFrame(odd, SCHEMA))).collect()}
    assert not got[1000].kept and not got[1001].kept and not got[1000].base_failed


def test_distance():
    p = np.array([[1.0, 1.0], [1.0, 0.0]])
    assert np.allclose(quality_rules.distance(p, np.array([5.0, 5.0])), [0, 0.3112781**0.5], atol=1e-6)


def test_distances_and_verdicts_match_brute_force(docs, rows):
    def classes(t):
        out = [0] * 8
        for c in t:
            out[0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 if ord(c) > 127 else 4 if c in " \t\n\r\x0b\x0c" else 5 if c in ".,;:!?'\"-()" else 6 if c in "#*$%&|<>" else 7] += 1
        return out

    def js(p, q):
        p, q = ([x / max(sum(v), 1e-300) for x in v] for v in (p, q))
        side = lambda u: sum(x * math.log2(2 * x / (a + b)) for x, a, b in zip(u, p, q, strict=True) if x)
        return max(0.0, (side(p) + side(q)) / 2) ** 0.5

    low = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    refs = {}
    for lang in {r[2] for r in rows if r[2]}:
        own = [r[1] for r in rows if r[2] == lang]
        n = Counter(w for t in own for w in low(t))
        top = sorted(n, key=lambda w: (-n[w], w))[:64]
        refs[lang] = ([sum(x) for x in zip(*map(classes, own), strict=True)], top, [n[w] for w in top] + [sum(n.values()) - sum(n[w] for w in top)])
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    for i, t, *_ in rows:
        n = Counter(low(t))
        both = [(js(classes(t or ""), c), js([n[w] for w in top] + [sum(n.values()) - sum(n[w] for w in top)], ref)) for c, top, ref in (refs[k] for k in sorted(refs))]
        c, w = min(both, key=sum)
        use_c, use_w = len(t or "") >= 200, sum(n.values()) >= 100
        assert (got[i].char_distance is not None, got[i].word_distance is not None) == (use_c, use_w)
        assert not use_c or abs(got[i].char_distance - c) < 1e-9
        assert not use_w or abs(got[i].word_distance - w) < 1e-9
        assert got[i].kept == (not got[i].base_failed and not (use_c and c > 0.32) and not (use_w and w > 0.5))


# --- language identification -------------------------------------------------


def test_language_identification(docs, rows):
    got = {r.doc_id: r for r in langid.predict(clash(docs), langid.train(docs, held_out=(3, 1))).collect()}
    for i, t, lang, *_ in rows:
        if i is not None and i < 140:
            assert got[i].lang_pred == lang and 0 <= got[i].score <= 1
    for i in (142, 143, 144):
        assert got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected


def test_language_predictions_match_plain_cosines(docs, rows):
    m = langid.train(docs)
    got = {r.doc_id: r for r in langid.predict(docs, m).collect()}
    for i, t, *_ in rows[:20] + rows[60:80]:
        raw = b" " + b" ".join(re.findall(rb"[a-z\x80-\xff]+", t.encode().lower())) + b" "
        v = [0.0] * langid.DIMS
        for k in range(1, 5):
            for j in range(len(raw) - k + 1):
                v[(int.from_bytes(raw[j : j + k], "big") + k * 0x3C6EF372) % 2**32 * 2654435761 % 2**32 >> 19] += 1
        v = [math.log1p(x) * float(w) for x, w in zip(v, m.idf, strict=True)]
        size = sum(x * x for x in v) ** 0.5
        cosines = [sum(x * float(y) for x, y in zip(v, c, strict=True)) / size for c in m.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert abs(got[i].cosine - cosines[best]) < 1e-4 and got[i].lang_pred == m.langs[m.owner[best]]
        assert got[i].rejected == (cosines[best] < m.floor[m.owner[best]])


def test_language_rejection(spark, docs):
    m = langid.train(docs)
    odd = spark.createDataFrame([(1, "ЖЗИ ЙКЛ МНО ПРС ТУФ ХЦЧ ШЩЪ ЫЬЭ ЮЯА БВГ", "xx", "s", 0), (2, "123 456 ...", "xx", "s", 0)], SCHEMA)
    got = {r.doc_id: r for r in langid.predict(odd, m).collect()}
    assert got[1].rejected and got[1].lang_pred in ("xx", "yy") and got[2].lang_pred == "und"
    assert langid.keep(odd.union(docs), m).where("doc_id < 3 and text rlike '[А-Я]'").count() == 0


# --- quality by nearest neighbours -------------------------------------------


def test_neighbour_votes_match_brute_force(spark, docs):
    labels = spark.createDataFrame([(i, int(i >= 60), 0) for i in range(120)] + [(5, None, 0), (None, 1, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    m = quality_knn.train(docs, labels, held_out=(5, 0))
    got = {r.doc_id: r for r in quality_knn.score(clash(docs), m).collect()}
    right = [(r.score >= 0.3) == (i >= 60) for i, r in got.items() if i is not None and i < 120 and zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(right) > 10 and np.mean(right) > 0.95
    assert got[142].score == 0 and got[142].predicted == 0
    text = docs.where("doc_id = 33").first().text
    x = quality_knn._scaled(quality_knn.counts(text, quality_knn._Shapes())[None].copy(), m.idf) @ m.basis
    cos = [(float(v @ x[0] / np.linalg.norm(v) / np.linalg.norm(x[0])), y) for v, y in zip(m.vectors.T, m.labels, strict=True)]
    best = sorted(cos, reverse=True)[: quality_knn.VOTERS]
    want = sum(max(c, 0) ** 8 * y for c, y in best) / sum(max(c, 0) ** 8 for c, _ in best)
    assert abs(got[33].score - want) < 1e-4


def test_tied_neighbours_vote_in_order_of_their_ids(spark):
    rng = random.Random(3)
    same, other = words(rng, 60), words(rng, 60, "klmnop")
    docs = spark.createDataFrame([(i, same) for i in range(8)] + [(i, other) for i in range(8, 12)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i < 3 or i >= 8)) for i in range(12)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality_knn.score(docs, quality_knn.train(docs, labels), voters=4).collect()}
    assert all(abs(got[i] - 0.75) < 1e-6 for i in range(8)) and abs(got[9] - 1) < 1e-6


# --- language model ------------------------------------------------------------


def test_base_score_matches_brute_force(docs, rows):
    counts: Counter = Counter()
    split = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    tokens = lambda t: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), b""]
    for i, t, *_ in rows:
        if not split(i):
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in lm.fit_and_score(clash(docs)).collect()}
    for i, t, *_ in rows:
        w, r = tokens(t), got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (split(i), len(w), sum(x in counts for x in w), n)
        assert abs(r.base_score - sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) < 1e-6


def test_the_model_learns_order(spark):
    rng = random.Random(5)
    text = lambda: " ".join(f"a{i % 7} b{i % 7}" for i in (rng.randrange(7) for _ in range(60)))
    got = lm.fit_and_score(spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string")).where("held_out").collect()
    assert len(got) > 15 and all(r.score > r.base_score + 10 for r in got)


def test_rare_words_are_joined(docs, rows, monkeypatch):
    want = {r.doc_id: (r.n_known, r.base_score) for r in lm.fit_and_score(docs).collect()}
    monkeypatch.setattr(lm, "HEAVY", 50)
    for r in lm.fit_and_score(docs).collect():
        assert r.n_known == want[r.doc_id][0] and abs(r.base_score - want[r.doc_id][1]) < 1e-6


def trained(docs, **params):
    """What fit_and_score learns from all of docs."""
    split = docs.select("doc_id", "text", F.lit(True).alias("train"))
    counts = lm.word_counts(split)
    v = lm.vocabulary(counts)
    return v, lm.train(lm.encode(split, v), v, **params)


@pytest.fixture(scope="module")
def language_model(docs):
    return trained(docs)


def test_unit_probabilities_sum_to_one(language_model):
    v, m = language_model
    assert v.classes > 5 and v.units == v.first[-1]
    for a, b in ((0, 0), (5, v.units), (v.units, v.units), (v.units - 1, 3)):
        every = np.arange(v.units)
        assert abs(np.exp(m.log_p(np.full_like(every, a), np.full_like(every, b), every)).sum() - 1) < 1e-4


def test_scores_of_a_trained_model_match_a_plain_sum(spark, language_model, rows):
    v, m = language_model
    docs = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", F.lit(True).alias("train"))
    coded = lm.encode(docs, v).cache()
    got = {r.doc_id: r.score for r in lm.score(coded, lm.word_counts(docs), v, m).collect()}
    counts = Counter(x for _, t, *_ in rows for x in [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), b""])
    place = {int(h): i for i, h in enumerate(v.heavy)}
    soft = lambda z: np.exp(z.astype(float)) / np.exp(z.astype(float)).sum()
    for i, t, *_ in rows[:40]:
        total, a, b = 0.0, v.units, v.units
        for w in [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), b""]:
            h = int(lm.hashes([w]).view(np.int64)[0])
            u = int(v.unit[place[h]]) if h in place else int(v.tail[lm.tails_of([w])[0]])
            k = int(np.searchsorted(v.first, u, "right")) - 1
            q = m.c1[a] + m.c2[b]
            own = slice(v.first[k], v.first[k + 1])
            total += math.log10(soft(m.r @ q + m.class_bias)[k]) + math.log10(soft(m.s[own] @ q + m.bias[own])[u - v.first[k]])
            if u in v.tail:
                total += math.log10((counts[w] + 0.1)) - v.within[u]
            a, b = u, a
        assert abs(got[i] - total) < 1e-3 * max(1, abs(total) / 100)


def test_scores_do_not_depend_on_the_layout(docs, monkeypatch):
    monkeypatch.setattr(lm, "FAN", 3)  # sums in several levels
    scores = [{(r.doc_id, r.n_tokens): r.score for r in lm.fit_and_score(docs.repartition(n), shard=300).collect()} for n in (1, 6, 32)]
    assert len(scores[0]) > 100
    for other in scores[1:]:
        assert all(abs(other[k] - x) < 1e-3 * max(1, abs(x)) for k, x in scores[0].items())


# --- decontamination -------------------------------------------------------------


@pytest.fixture(scope="module")
def leaky(spark):
    rng = random.Random(2)
    items = [(i, words(rng, rng.choice([1, 3, 16, 25, 40, 59]))) for i in range(40)] + [(40, None), (41, ""), (42, "...")]
    docs = []
    for i in range(200):
        w = words(rng, rng.choice([0, 10, 80, 300])).split()
        edits = -1
        if i % 2:
            it = rng.choice([x for x in items if x[1] and len(x[1].split()) > 10])
            u = it[1].split()
            edits = rng.choice([0, 0, 1, 2, len(u) // 5, len(u) // 4 + 1])
            for _ in range(edits):
                j = rng.randrange(len(u))
                u[j : j + 1] = rng.choice([[], [words(rng, 1)], [u[j], words(rng, 1)]])
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() + rng.choice(["", "!", ","]) for x in u]
        docs.append((i, " ".join(w), "xx", "s", 0))
    docs += [(300, None, None, None, None), (301, "word " * 3000, "xx", "s", 0)]
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), docs, items


def edit_fit(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (v != w)))
        row = new
    return min(row)


def test_leaks_match_brute_force(leaky):
    docs, items, d, it = leaky
    got = {(r.doc_id, r.item_id): r.distance for r in decontam.find(clash(docs), items).collect()}
    want = {}
    for i, t, *_ in d:
        w = decontam.plain_words(t)
        for k, s in it:
            u = decontam.plain_words(s)
            if u and len(w) < 2000:
                e = edit_fit(u, w)
                if e <= math.floor(0.2 * len(u) + 1e-9):
                    want[i, k] = e
    assert len(want) > 50 and set(got) <= set(want)
    assert len(set(want) - set(got)) <= 0.01 * len(want)
    assert all(got[k] == want[k] for k in got)


def test_leaky_documents_go(leaky):
    docs, items, *_ = leaky
    bad = {r.doc_id for r in decontam.find(docs, items, block=7).collect()}
    kept = {r.doc_id for r in decontam.keep(clash(docs), items, block=7).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.collect()} - bad


@pytest.mark.parametrize("kind", ["delete", "insert", "replace"])
def test_leaks_of_long_items(kind):
    rng = random.Random(8)
    hashes = WordHashes()
    for length in (120, 200, 400, 1000):
        item = words(rng, length, "abcdefghijklmnopqrst").split()
        items = decontam.Items([7], [hashes.of(decontam.plain_words(" ".join(item)))], 0.2, decontam.REPEATS, decontam.BITS)
        for _ in range(8):
            at = set(rng.sample(range(length), length // 5))
            other = lambda: words(rng, 1, "uvwxyz")
            leak = [v for i, u in enumerate(item) for v in ([u] if i not in at else {"delete": [], "insert": [u, other()], "replace": [other()]}[kind])]
            text = " ".join([*words(rng, 300, "uvwxyz").split(), *leak, *words(rng, 200, "uvwxyz").split()])
            got = decontam.leaks(hashes.of(decontam.plain_words(text)), items)
            assert set(got) == {0} and got[0][0] <= length // 5 and abs(got[0][1] - 300) <= length // 5


# --- mixing ------------------------------------------------------------------------


def test_rates_reach_the_targets(spark, docs, rows):
    labels = spark.createDataFrame([(i, int(i >= 60), 0) for i in range(120)] + [(1, None, None)], "doc_id long, quality int, toxic int")
    target = {"quality=0,toxic=0": 0.25, "quality=1,toxic=0": 0.75}
    out = mixing.weigh(clash(docs), labels, target).collect()
    assert len(out) == len(rows) and all(r.rate >= 0 for r in out)
    total = sum(r.n_tokens for r in out)
    for k, share in target.items():
        assert abs(sum(r.n_tokens * r.rate * r.posteriors[k] for r in out) / total - share) < 1e-3
    mixed = mixing.mix(clash(docs), labels, target)
    assert mixed.columns[-2:] == ["_rate", "copies"] and mixed.where("copies < 1").count() == 0


def test_rates_match_a_plain_solver(docs, rows, spark):
    labels = spark.createDataFrame([(i, int(i >= 60), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    target = {"quality=0,toxic=0": 0.4, "quality=1,toxic=0": 0.6}
    out = mixing.weigh(docs, labels, target).collect()
    names = sorted(out[0].posteriors)
    p, n = np.array([[r.posteriors[k] for k in names] for r in out]), np.array([r.n_tokens for r in out], float)
    want = np.ones(len(out))
    weight = np.linalg.inv((p * n[:, None]).T @ p / n.sum() + 1e-7 * np.eye(len(names)))
    for _ in range(mixing.STEPS):
        residual = (n * want) @ p / n.sum() - np.array([target[k] for k in names])
        if np.abs(residual).max() < mixing.TOLERANCE:
            break
        want = np.maximum(0, want - p @ (weight @ residual))
    assert np.allclose([r.rate for r in out], want, atol=1e-6)


def test_without_labels_all_rates_are_one(spark, docs, none):
    out = mixing.weigh(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert {r.rate for r in out} == {1.0} and {r.copies for r in out} == {1}


# --- URLs ----------------------------------------------------------------------------


def test_url_rules(spark):
    cases = [
        ("http://www.Example.ORG/es/1", "www.example.org", "/es/1", "example.org/es/", "block"),
        ("https://example.org/en/12?x#y", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://example.org/fr", "example.org", "/fr", "org/", "allow"),
        ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://a.com/de/x", "a.com", "/de/x", "com/de/", "block"),
        ("http://a.com", "a.com", "", None, None),
        ("http://org", "org", "", None, None),
        ("ftp://u://v.org/x", "u:", "//v.org/x", None, None),
        ("no host", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://x.com#/de/", "x.com", "", None, None),
        ("line\nhttp://x.com/fr/1", "x.com", "/fr/1", "com/fr/", "allow"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "page_id long, url string").withColumn("host", F.lit("clash"))
    for r in urls.judge(df).collect():
        _, host, path, rule, verdict = cases[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_url_models_tell_what_rules_taught(spark):
    rng = random.Random(3)
    rows = [(i, f"https://h{rng.randrange(30)}.example.{('com', 'net')[i % 3 == 0]}/{rng.choice(['fr', 'de'])}/{rng.randrange(999)}") for i in range(900)]
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    free = [r for r in out if r.rule is None]
    assert len(free) > 200 and np.mean([(r.verdict == "block") == r.path.startswith("/de/") for r in free]) > 0.95


def brute_ratio(learned, url, order=4, strength=4.0):
    """By counting in plain dictionaries, without leaving out any context."""
    grams = [Counter(), Counter()]
    split = lambda u: [(k, raw[i - k : i], raw[i : i + 1]) for raw in [b"\0" * order + u.encode() + b"\1"] for i in range(order, len(raw)) for k in range(order + 1)]
    for u, v in learned:
        grams[v == "block"].update(split(u))
    mass = [sum(n for (k, _, _), n in g.items() if k == 0) for g in grams]
    total = 0.0
    for side, sign in ((0, -1), (1, 1)):
        contexts = Counter()
        for (k, c, _), n in grams[side].items():
            contexts[k, c] += n
        w = min(mass) / mass[side]
        p = 1 / 256
        for k, c, x in split(url):
            p = 1 / 256 if k == 0 else p
            p = (w * grams[side][k, c, x] + strength * p) / (w * contexts[k, c] + strength)
            total += sign * math.log(p) if k == order else 0
    return total / (len(url.encode()) + 1)


@pytest.fixture(scope="module")
def decided(spark):
    rng = random.Random(4)
    rows = [(f"https://h{rng.randrange(40)}.example.com/{('fr', 'de')[i % 3 == 0]}/{rng.randrange(999)}é", ("allow", "block")[i % 3 == 0]) for i in range(600)]
    return rows, spark.createDataFrame(rows, "url string, verdict string")


def test_url_ratio_matches_plain_counting(decided):
    rows, df = decided
    model = urls.train(df)
    fold = {r.url for r in df.select("url").distinct().where("pmod(xxhash64(url), 5) = 0").collect()}
    learned = [r for r in rows if r[0] not in fold]
    for url in (rows[0][0], "https://h1.example.com/de/77", "ftp://elsewhere/ü", "x"):
        assert abs(model.ratio([url])[0] - brute_ratio(learned, url)) < 1e-9


@pytest.mark.parametrize("contexts", [1 << 14, 40])
def test_url_probabilities_sum_to_one(decided, monkeypatch, contexts):
    """Also where most contexts are left out."""
    monkeypatch.setattr(urls, "CONTEXTS", contexts)
    model = urls.train(decided[1])
    assert all(len(k[k >> 32 == o]) <= contexts for k, _ in model.contexts for o in range(5))
    for before in ("", "https://h1.example.com/d", "zzzz"):
        for side in (0, 1):
            keys, _ = urls._keys([before])  # the last position is the end: put each byte there
            p = np.full(256, 1 / 256)
            for key in keys:
                n = urls._count(model.contexts[side], key[-1:] >> 8)
                if n[0]:
                    p = (urls._count(model.grams[side], (key[-1] >> 8 << 8) + np.arange(256)) + urls.STRENGTH * p) / (n + urls.STRENGTH)
            assert abs(p.sum() - 1) < 1e-9 and abs(np.log(p[1]) - model.log_p(side, [before])[0][-1]) < 1e-9


# --- HTML ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return html_extract.train(html_extract.labelled_pages())


def test_marginals_on_unseen_pages(model):
    right = total = 0
    for page, marks in html_extract.labelled_pages(40, seed=123):
        nodes, _ = html_extract.parse(page)
        p = model.marginals(nodes)
        for i, n in enumerate(nodes):
            if n.own:
                total += 1
                right += (p[i] > 0.5) == (marks[i] == "1")
    assert right / total > 0.95


def test_marginals_are_exact(model):
    """Sum-product against the sum over all labellings of a small tree."""
    nodes, _ = html_extract.parse("<div class=ad><p>aa</p><article><p>some text</p><a href=x>b</a></article></div>")
    n = len(nodes)
    total, on = 0.0, [0.0] * n
    for bits in range(1 << n):
        s = [bits >> i & 1 for i in range(n)]
        p = 1.0
        for i, x in enumerate(nodes):
            if s[i]:
                p *= math.exp(sum(model.node.get(f, 0.0) for f in html_extract.features(x)))
            if i:
                p *= model.edge.get(html_extract.kind(nodes[x.parent]), model.edge["any"])[s[x.parent]][s[i]]
        total += p
        for i in range(n):
            on[i] += p * s[i]
    assert np.allclose(model.marginals(nodes), [x / total for x in on], atol=1e-9)


def test_extraction(model):
    page = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav><!-- <p>gone</p> -->
    <div class="ad">Buy now</div><article><h1>The  title &amp; more</h1><p>First&nbsp;text &lt;b&gt; with <b>bold</b> and <a href=x>a link</a>.<br>Second line<p>Third
    line of some length here</article><div class="comments"><p>Nice post</p></div><footer>&copy; site</footer>"""
    assert html_extract.extract(page, model) == "The title & more\nFirst text <b> with bold and a link.\nSecond line\nThird line of some length here"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><h1>Title here</h1><p>One sentence of text that is long enough.</p><ul><li><a href='/a'>First source</a></li><li><a href='/b'>Second source</a></li><li><a href='/c'>Third</a></li></ul></article>", "Title here\nOne sentence of text that is long enough.\nFirst source\nSecond source\nThird"),
        ("<html><body>Just some bare text without any tags inside.</body></html>", "Just some bare text without any tags inside."),
        ("plain text only", "plain text only"),
        ("<html><head><title>x</title></head><body><nav><ul><li><a href=x>Home</a></li><li><a href=y>About</a></li></ul></nav><p>A first paragraph of the text.</p><p>A second paragraph of the text, longer.</p><footer>c 2020</footer></body></html>", "A first paragraph of the text.\nA second paragraph of the text, longer."),
        ("<body><div class='content'><p>Hello world this is text.</p><figure><img src=x><figcaption>A caption</figcaption></figure><dl><dt>Term</dt><dd>Meaning of it</dd></dl></div><div class='sidebar'><ul><li><a href=x>More</a></li></ul></div></body>", "Hello world this is text.\nA caption\nTerm\nMeaning of it"),
        ("<main><h1>Title</h1><p>Text text text text text.</p><h2>References</h2><ol><li>Author: <a href=x>Book</a>, 1990.</li></ol></main><aside>ad</aside>", "Title\nText text text text text.\nReferences\nAuthor: Book, 1990."),
        ("<div><p>First paragraph of a page without any telling name.</p><p>Second one with a <a href=x>link</a> in it.</p></div>", "First paragraph of a page without any telling name.\nSecond one with a link in it."),
        ("<article><p>Text of the article is here and goes on.</p><nav><a href=1>prev</a><a href=2>next</a></nav><div class='share'><a href=t>Tweet</a></div><form><input><label>Mail</label></form></article>", "Text of the article is here and goes on."),
    ],
)
def test_hand_written_pages(model, page, text):
    assert html_extract.extract(page, model) == text


@pytest.mark.parametrize("page", ["<div>" * 200_000 + "x", '<a "' * 250_000, "<a '\"" * 200_000, "<" * 1_000_000, "<li>" * 200_000, "<p>x" * 100_000, "<div>" * 100_000 + "</span>" * 100_000, "<!-" * 300_000, "<!x " * 200_000, "<table><tr><td>" * 60_000, "<a " + 'class="' * 150_000 + ">x"])
def test_broken_pages_take_linear_time(model, page):
    began = time.process_time()
    html_extract.extract(page, model)
    assert time.process_time() - began < 5


@pytest.mark.parametrize("page", [None, "", "plain", "<", "<p", "<p>" * 3000, "</div>" * 50, "<!-- never closed", "<script>x", "<p a='b>c", "<div>" * 2000 + "x", "\x00<p>\x00", "&#xD800;&bogus;", "<table><tr><td>a<td>b<tr><td>c</table>"])
def test_odd_pages(model, page):
    assert isinstance(html_extract.extract(page, model), str)


def test_main_text_columns(spark, model):
    df = spark.createDataFrame([(1, "u", None), (2, None, "<article><p>é text in here</p></article>")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in html_extract.main_text(df, model).collect()}
    assert (got[1].text, got[1].n_chars) == ("", 0) and got[2].text == "é text in here" and got[2].n_chars == 14


# --- licences ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def notices():
    return licenses.train()


def test_licences(spark, notices):
    rng = random.Random(6)
    texts, want = [], {}
    for f, ts in licenses.TEMPLATES.items():
        for t in ts:
            assert re.search(licenses.HAS_WORD, t), t
            want[len(texts)] = f
            texts.append(f"{words(rng, 20)}\n{t}")
    for t in licenses.OTHERS:
        texts.append(f"{t}\nand more")
    texts += [None, "", "\n\n", words(rng, 5000)]
    df = clash(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = licenses.scan(df, notices).collect()
    assert {r.doc_id: r.family for r in got if r.confirmed} == {**want, **{r.doc_id: r.family for r in got if r.confirmed and r.doc_id not in want}}
    assert sum(r.doc_id not in want and r.confirmed for r in got) == 0
    assert all(r.paragraph == 1 for r in got if r.doc_id in want)


def test_licence_probabilities_match_brute_force(spark, notices):
    texts = [t for ts in licenses.TEMPLATES.values() for t in ts]
    got = {r.doc_id: r.probability for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), notices).collect()}
    for i, p in got.items():
        z = np.array(notices.bias)
        for g in licenses.grams(texts[i]):
            if g in notices.weights:
                z = z + np.array(notices.weights[g])
        e = np.exp((z - z.max()) / notices.temperature)
        assert abs(p - (e / e.sum()).max()) < 1e-9


def test_licences_without_customary_words_and_wrapped(spark, notices):
    unlicense = "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    mit = licenses.TEMPLATES["MIT"][2]
    rng = random.Random(9)
    want = {0: ("GPL", {0}), 1: ("GPL", {0}), 2: ("GPL", {0}), 3: ("Unlicense", {0}), 4: ("Unlicense", set(range(8))), 5: ("Unlicense", {2, 3, 4}), 6: ("MIT", set(range(1, 10)))}
    texts = ["This software is under the GNU GPL v3.", "Distributed under the terms of the GNU GPL, version 3.", "GPL-3.0-or-later", unlicense, textwrap.fill(unlicense, 30), f"{words(rng, 200)}\n\n{textwrap.fill(unlicense, 72)}\n\n{words(rng, 200)}", f"{words(rng, 90)}\n{textwrap.fill(mit, 40)}\n{words(rng, 90)}"]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), notices).collect()
    assert {(r.doc_id, r.family) for r in got} == {(i, f) for i, (f, _) in want.items()}
    assert all(r.paragraph in want[r.doc_id][1] for r in got)


def test_licences_of_repeated_rows_null_ids_and_shuffled_input(spark, notices):
    wrapped = textwrap.fill(licenses.TEMPLATES["MIT"][2], 40)
    rows = [(1, wrapped), (1, wrapped), (1, "Released under the MIT License.\nReleased under the MIT License."), (None, wrapped), (None, "Licensed under CC BY 4.0."), (None, "Licensed under CC BY 4.0."), (2, wrapped), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = {(k, t): [tuple(r)[1:] for r in licenses.scan(spark.createDataFrame([(k, t)], df.schema), notices).collect()] for k, t in rows}
    want = sorted(((k, *r) for k, t in rows for r in one[k, t]), key=repr)
    assert len(one[1, rows[2][1]]) == 2 and len(one[1, wrapped]) == 1
    assert sorted(map(tuple, licenses.scan(df.repartition(3), notices).collect()), key=repr) == want


def test_licence_plan_runs_no_python(spark, notices):
    df = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    plan = licenses.scan(df, notices)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- empty tables ---------------------------------------------------------------------------------


def test_text_ids(spark, docs):
    """Ids may be texts, too, where no contract asks for integers."""
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    labels = spark.createDataFrame([(f"d{i}", int(i >= 60), 0) for i in range(120)], "doc_id string, quality int, toxic int")
    bench = spark.createDataFrame([("q", docs.where("doc_id = 12").first().text)], "item_id string, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find(named, bench).collect()} == {("d12", "q")}
    assert mixing.weigh(named, labels).where("doc_id = 'd3'").count() == 1
    scores = {r.doc_id: r.predicted for r in quality_knn.score(named, quality_knn.train(named, labels)).collect()}
    assert (scores["d3"], scores["d70"]) == (0, 1)


def test_empty_tables(spark, none, notices, model):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    frames = [
        licenses.scan(none, notices), lm.fit_and_score(none), langid.predict(none, langid.train(none)), neardup.groups(none), decontam.find(none, bench), mixing.weigh(none, labels),
        quality_rules.judge(none), urls.judge(pages), quality_knn.score(none, quality_knn.train(none, labels)), html_extract.main_text(pages, model),
        neardup.keep(none), decontam.keep(none, bench), langid.keep(none, langid.train(none)), quality_rules.keep(none), mixing.mix(none, labels),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_models_of_empty_tables(spark, docs, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.lang_pred for r in langid.predict(docs, langid.train(none)).collect()} == {"und"}
    assert {r.score for r in quality_knn.score(docs, quality_knn.train(docs, labels)).collect()} == {0.0}
    assert decontam.find(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


# --- pipeline ---------------------------------------------------------------------------------------


def test_pipeline(spark, docs, rows, tmp_path):
    import corpus_pipeline

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i >= 60), 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    leak = rows[50][1].split()
    spark.createDataFrame([(1, " ".join(leak[10:45]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "minhash_neardup", "decontamination", "mixing"]
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, str(tmp_path))
        assert d.columns == docs.columns
        left[name] = {r.doc_id for r in d.select("doc_id").collect()}
    assert {142, 143, 144}.isdisjoint(left["language_id"]) and set(range(120)) <= left["language_id"]
    assert {145, 146}.isdisjoint(left["quality_rules"]) and set(range(120)) <= left["quality_rules"]
    assert left["minhash_neardup"] & {5, 140, 141} == {5}
    assert left["minhash_neardup"] - left["decontamination"] == {50}
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert set(out.columns) == {*docs.columns, "rate", "copies"} and {r.doc_id for r in out.select("doc_id").collect()} <= left["decontamination"]
