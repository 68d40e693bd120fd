"""Similarity joins and greedy grouping against plain loops."""

import random
import time

import pytest

from caudal.operators import alike, fuzzy


def words(rng, n, letters="aeioulnrstcdpm", lo=3, hi=8):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(lo, hi))) for _ in range(n)]


def names(rng, n, vocabulary):
    return ["colegio " + " ".join(rng.sample(vocabulary, 3)) for _ in range(n)]


def near_copies(rng, texts, n):
    out = []
    for t in rng.choices(texts, k=n):
        t = list(t)
        for _ in range(rng.randint(1, 4)):
            t[rng.randrange(len(t))] = rng.choice("aeiou ")
        out.append(" ".join("".join(t).split()))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = names(rng, 150, words(rng, 400))
    out += near_copies(rng, out, 60) + [" ".join(words(rng, 40)) for _ in range(4)]
    return out + [out[0], out[-1] + " x", "b a a", "a b", "a", "ñandú", "ñandu"]


def test_subsequences_of_long_texts():
    rng = random.Random(1)
    a, b = (["".join(rng.choice("abcd") for _ in range(rng.choice((0, 1, 63, 64, 65, 200)))) for _ in range(30)] for _ in range(2))
    import numpy as np

    i, j = (x.ravel() for x in np.indices((30, 30)))
    assert alike.subsequences(a, b, i, j).tolist() == [fuzzy.common_subsequence(a[x], b[y]) for x, y in zip(i, j, strict=True)]


def test_similarity_join(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    score = {(i, j): fuzzy.similarity(texts[i], texts[j]) for i in range(len(texts)) for j in range(i + 1, len(texts))}
    for least in (59.5, 80.0, 85.0):
        want = {p: s for p, s in score.items() if s >= least}
        got = alike.similarity_join(df, least, block=64).collect()
        assert len(got) == len(want) and {(r.a, r.b): r.similarity for r in got} == want
    two = {p for p, s in score.items() if s >= 59.5 and len(set(texts[p[0]].split()) & set(texts[p[1]].split())) >= 2}
    assert {(r.a, r.b) for r in alike.similarity_join(df, 59.5, shared=2, block=64).collect()} == two
    assert alike.similarity_join(df.limit(0), 80.0).count() == 0


def test_similarity_join_of_2000_names(spark):
    rng = random.Random(2)
    some = names(rng, 2000, words(rng, 400, "abcdefghijklmnopqrstuvwxyz"))
    df = spark.createDataFrame(list(enumerate(some)), "k long, t string").cache()
    df.count()
    every = len(some) * (len(some) - 1) // 2
    for least, share in ((59.5, 0.25), (85.0, 0.05)):
        began = time.time()
        n = alike.similarity_join(df, least).count()
        assert n < share * every and time.time() - began < 30


def greedy_groups(similar, n):
    """Group openers of n rows in order, by a function of two rows."""
    group = [None] * n
    for i in range(n):
        if group[i] is None:
            group[i] = i
            for j in range(i + 1, n):
                if group[j] is None and similar(i, j):
                    group[j] = i
    return group


@pytest.mark.parametrize("most", [10**6, 40, 0])
def test_greedy(spark, most):
    rng = random.Random(most)
    n = 2000 if most == 10**6 else 120
    name = [rng.randrange(n) if rng.random() < 0.8 else i for i in range(n)]
    first = {}
    for i, v in enumerate(name):
        first.setdefault(v, i)
    rows = [(i, first[name[i]]) for i in range(n)]
    pairs = {(a, b) for a, b in ((rng.choice(rows)[1], rng.choice(rows)[1]) for _ in range(n // 2)) if a < b}
    links = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(n // 2)}
    links |= {(i, i + 1) for i in range(n // 2, n // 2 + (600 if most == 10**6 else 12))}  # a chain in order
    frames = (spark.createDataFrame(rows, "k long, u long"), spark.createDataFrame(sorted(pairs), "a long, b long"), spark.createDataFrame(sorted(links), "a long, b long"))
    u = dict(rows)
    linked = lambda i, j: u[i] == u[j] or (min(u[i], u[j]), max(u[i], u[j])) in pairs or (i, j) in links
    got = sorted((r.k, r.opener) for r in alike.greedy(*frames, most=most).collect())
    assert got == list(enumerate(greedy_groups(linked, n)))


def test_fuzzy_clusters_are_the_greedy_ones(spark, texts):
    rng = random.Random(8)
    places = [*names(rng, 20, words(rng, 30)), "", None]
    rows = [(i, t, rng.choice(places)) for i, t in enumerate(texts)] + [(1000 + i, rng.choice(texts), rng.choice(places)) for i in range(60)] + [(2000, "", "cl 1"), (2001, "", "cl 1")]
    df = spark.createDataFrame(rows, "k long, n string, p string").selectExpr("k", "n", "'' as d", "p")
    from caudal.functions.text import plain_lower

    plain = {r.k: (r.n, r.p) for r in df.select("k", plain_lower("n").alias("n"), plain_lower("p").alias("p")).collect()}
    keys = sorted(plain)

    def linked(i, j):
        (a, p), (b, q) = plain[keys[i]], plain[keys[j]]
        s = fuzzy.similarity(a, b)
        return s >= 85 or (s >= 0.7 * 85 and fuzzy.similarity(p, q) >= 0.7 * 85)

    openers = greedy_groups(linked, len(keys))
    number = {o: n for n, o in enumerate(sorted(set(openers)))}
    got = {r.k: r.cluster_fuzzy for r in fuzzy.fuzzy_clusters(df, "k", "n", "d", "p").collect()}
    assert got == {k: number[o] for k, o in zip(keys, openers, strict=True)}


def test_alike_names_without_addresses_make_no_pairs(spark, monkeypatch):
    made = []

    def joined(*args):
        out = alike.similarity_join(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(fuzzy, "similarity_join", joined)
    rows = [(k, f"Supplier#{k:09d}", "sede", "") for k in range(200)] + [(200, "Supplier#000000199", "sede", "calle 5"), (201, "Supplier#000000777", "sede", "calle 5")]
    got = {r.k: r.cluster_fuzzy for r in fuzzy.fuzzy_clusters(spark.createDataFrame(rows, "k long, n string, d string, p string"), "k", "n", "d", "p", 97.0).collect()}
    assert sum(made) < 10 and got == {**{k: k for k in range(200)}, 200: 199, 201: 200}


@pytest.mark.parametrize("vocabulary, head", [(400, (8, 32)), (8, (16, 16)), (30, alike.HEAD)])
def test_greedy_groups_of_alike_rows(spark, vocabulary, head):
    rng = random.Random(vocabulary)
    some = names(rng, 50, words(rng, vocabulary)) + [f"supplier#{k:09d}" for k in rng.sample(range(10**6), 25)]
    places = [*names(rng, 10, words(rng, 30)), "", ""]
    rows = sorted({(t, rng.choice(places)) for t in some + near_copies(rng, some, 40) + rng.choices(some, k=20)})
    rng.shuffle(rows)

    def linked(i, j):
        s = fuzzy.similarity(rows[i][0], rows[j][0])
        return s >= 85 or (s >= 0.7 * 85 and fuzzy.similarity(rows[i][1], rows[j][1]) >= 0.7 * 85)

    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k long, name string, address string").repartition(3)
    got = sorted((r.k, r.opener) for r in alike.greedy_alike(df, 85.0, head, 16).collect())
    assert got == list(enumerate(greedy_groups(linked, len(rows))))
    assert alike.greedy_alike(df.limit(0), 85.0, head).count() == 0


def test_alike_names_are_grouped_without_pairs(spark, monkeypatch):
    written = []

    def kept(df, tag):
        out = cut(df, tag)
        written.append(out.count())
        return out

    cut = alike.cut
    for module in (alike, fuzzy):
        monkeypatch.setattr(module, "cut", kept)
    rows = [(k, f"Supplier#{k:09d}", "sede", f"calle {k % 7}") for k in range(1500)]
    got = {r.k: r.cluster_fuzzy for r in fuzzy.fuzzy_clusters(spark.createDataFrame(rows, "k long, n string, d string, p string"), "k", "n", "d", "p").collect()}
    assert got == dict.fromkeys(range(1500), 0) and max(written) <= 1500


def test_the_query_groups_suppliers_as_plain_loops_do(spark):
    from pathlib import Path

    from caudal.queries import load

    data = "/root/testdata/sf0.01"
    if not Path(data).exists():
        pytest.skip("the driver's tables are not here")
    parts = {r.p_partkey: r.p_name for r in spark.read.parquet(f"{data}/part.parquet").collect()}
    rows = sorted((r.s_suppkey, f"{r.s_name} {parts[r.s_suppkey]}".lower(), str(r.s_acctbal)) for r in spark.read.parquet(f"{data}/supplier.parquet").collect())

    def linked(i, j):
        s = fuzzy.similarity(rows[i][1], rows[j][1])
        return s >= 85 or (s >= 0.7 * 85 and fuzzy.similarity(rows[i][2], rows[j][2]) >= 0.7 * 85)

    openers = greedy_groups(linked, len(rows))
    number = {o: n for n, o in enumerate(sorted(set(openers)))}
    assert len(rows) / 10 < len(number) < len(rows) / 2
    got = {r.k: r.cluster_fuzzy for r in load()[0]["fuzzy_clusters"](spark, data).collect()}
    assert got == {r[0]: number[o] for r, o in zip(rows, openers, strict=True)}
