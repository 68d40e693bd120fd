"""Keyed tables: untouched buckets keep their files, and writers do not overwrite one another."""

import pytest

from caudal.sources import keyed


def frame(spark, *rows):
    return spark.createDataFrame(rows, "k long, v string")


def content(spark, path):
    return sorted((r.k, r.v) for r in keyed.read_current(spark, path).collect())


def files_of(path):
    return {f.relative_to(path) for f in (path / "data").rglob("*.parquet")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = tmp_path / "t"
    keyed.write_upsert(frame(spark, *((i, "a") for i in range(200))), str(path), "k", buckets=16, keep=5)
    first = files_of(path)
    keyed.write_upsert(frame(spark, (3, "b"), (1000, "c")), str(path), "k", keep=5)
    new = files_of(path) - first
    assert first <= files_of(path) and 1 <= len(new) <= 2
    manifest = keyed.Store(spark, str(path)).read(keyed._file(2))
    assert len(manifest["at"]) <= 16 and len(set(manifest["at"].values())) == 2
    assert content(spark, str(path)) == sorted([(i, "a") for i in range(200) if i != 3] + [(3, "b"), (1000, "c")])


def racing(spark, path, monkeypatch, *rows, times=1, **options):
    """Another writer commits rows just before this one would."""
    create, left = keyed.Store.create, [times]

    def first(self, name, value):
        if left[0]:
            left[0] -= 1
            monkeypatch.setattr(keyed.Store, "create", create)
            keyed.write_upsert(frame(spark, *rows), path, "k", keep=9, **options)
            monkeypatch.setattr(keyed.Store, "create", first)
        return create(self, name, value)

    monkeypatch.setattr(keyed.Store, "create", first)


def test_other_writers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    keyed.write_upsert(frame(spark, *((i, "a") for i in range(50))), path, "k", buckets=50)
    of = {r.k: r.b for r in frame(spark, *((i, "") for i in range(50))).select("k", keyed._bucket("k", 50).alias("b")).collect()}
    other = next(k for k in range(1, 50) if of[k] != of[0])
    same = next(k for k in range(1000) if k and frame(spark, (k, "")).select(keyed._bucket("k", 50)).first()[0] == of[0])
    with monkeypatch.context() as m:  # other buckets: put on top, nothing merged again
        racing(spark, path, m, (other, "theirs"))
        assert keyed.write_upsert(frame(spark, (0, "mine")), path, "k", keep=9) == 3
    assert dict(content(spark, path))[0] == "mine" and dict(content(spark, path))[other] == "theirs"
    with monkeypatch.context() as m:  # the same bucket: merged again
        racing(spark, path, m, (same, "theirs"))
        assert keyed.write_upsert(frame(spark, (0, "again")), path, "k", keep=9) == 5
    assert dict(content(spark, path))[0] == "again" and dict(content(spark, path))[same] == "theirs"
    with monkeypatch.context() as m, pytest.raises(keyed.Conflict):
        racing(spark, path, m, (same, "once more"), times=9)
        keyed.write_upsert(frame(spark, (0, "never")), path, "k", keep=9, attempts=2)
    assert dict(content(spark, path))[0] == "again"


def test_odd_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        keyed.read_current(spark, path)
    assert keyed.write_upsert(frame(spark), path, "k") == 1 and content(spark, path) == []
    rows = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (None, "n", 1)], "k long, v string, at int")
    keyed.write_upsert(rows, path, "k", order="at", keep=1)
    assert {(r.k, r.v, r.at) for r in keyed.read_current(spark, path).collect()} == {(1, "b", 6), (None, "n", 1)}
    assert keyed.write_upsert(frame(spark, (2, "x")), path, "k", keep=1) == 3  # a column fewer
    assert {(r.k, r.v, r.at) for r in keyed.read_current(spark, path).collect()} == {(1, "b", 6), (None, "n", 1), (2, "x", None)}
    assert len(list((tmp_path / "t" / "_manifests").glob("*.json"))) == 1


def test_numbers_go_on(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    keyed.write_upsert(frame(spark, (5, "a"), (3, "b")), path, "k", identity="id")
    racing(spark, path, monkeypatch, (9, "theirs"), identity="id")
    keyed.write_upsert(frame(spark, (3, "c"), (7, "d")), path, "k", identity="id")
    assert {(r.k, r.id) for r in keyed.read_current(spark, path).collect()} == {(3, 1), (5, 2), (9, 3), (7, 4)}
