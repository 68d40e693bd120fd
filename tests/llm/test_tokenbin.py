"""Bit-plane token files: round trips, planes, and ids and positions against the tokenizer itself."""

import io
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from caudal.llm import tokenbin

os.environ["TOKENIZERS_PARALLELISM"] = "false"
tokenizers = pytest.importorskip("tokenizers")
TOKENIZER = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def spec():
    with open(TOKENIZER, encoding="utf-8") as f:
        return f.read()


def texts():
    rng = random.Random(3)
    letters = "abcXYZ éÉñßÇİΣςǰJ̌́—«»'\"\\<|>.,;:!?()#%&*019漢字\u00a0\u2028\x0b\x0c\x1c\x00\t\n~_-"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    return out + ["Don't stop. IT'S 12'll <|endoftext|>x <|ENDOFTEXT|> a<|startoftext|>", "J\u030c j\u030c \u01f0 e\u0301a\u030a", "Ünïcödé,,, Façade... niño!? ÿ ß µ ª", "a" * 3000, "x'. y\\. z~. (a) »b» c»."]


def test_words_have_the_ids_of_the_text(spec):
    by_words, _ = tokenbin.encoder(spec, 1, True)
    whole, _ = tokenbin.encoder(spec, 1, False)
    some = [*texts(), None, ""]
    assert by_words(pa.array(some)).to_pylist() == whole(pa.array(some)).to_pylist()
    assert by_words(pa.array(some).slice(7, 50)).to_pylist() == whole(pa.array(some[7:57])).to_pylist()
    assert by_words(pa.array([], pa.string())).to_pylist() == []


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_planes(kind):
    rng = np.random.default_rng(1)
    for n, most in ((0, 1), (1, 1), (7, 1), (8, 2), (1000, 49408), (333, 1 << 32)):
        ids = rng.integers(0, most, n, dtype=np.uint32)
        planes = tokenbin.to_planes(ids, kind)
        assert len(planes) <= (most.bit_length() if kind == "bit" else 4)
        assert tokenbin.from_planes(planes, n, kind).tolist() == ids.tolist()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_one_file(kind):
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 50_000, n, dtype=np.uint32) for n in (1, 5, 0, 300, 64, 63, 65, 1)]
    out = io.BytesIO()
    w = tokenbin.ShardWriter(out, kind, block=64)
    w.add(pa.array([4, 5, 6, 7]), docs[:4])
    w.add(pa.array([8, 9, 10, 11]), docs[4:])
    w.close()
    r = tokenbin.ShardReader(io.BytesIO(out.getvalue()))
    got = [(i, s, n, ids) for index, parts in r.documents(rows=3) for i, s, n, ids in zip(*(c.to_pylist() for c in index.columns), parts, strict=True)]
    starts = np.cumsum([0, *map(len, docs)])
    assert got == [(4 + k, starts[k], len(d), d.astype("<u4").tobytes()) for k, d in enumerate(docs)]
    assert r.ids(2, 100).tolist() == np.concatenate(docs)[2:102].tolist()
    broken = bytearray(out.getvalue())
    broken[tokenbin.ShardReader(io.BytesIO(out.getvalue())).chunks.column("offset")[1].as_py() + 20] ^= 255
    with pytest.raises(Exception):  # noqa: B017  zstandard's or the crc32's
        list(tokenbin.ShardReader(io.BytesIO(bytes(broken))).documents())
    with pytest.raises(ValueError):
        tokenbin.ShardReader(io.BytesIO(out.getvalue()[:-1]))


def expected(rows):
    t = tokenizers.Tokenizer.from_file(TOKENIZER)
    at, out = 0, []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def digest(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_table(spark, tmp_path, planes):
    rows = list(enumerate(texts()))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "word " * 70_000), (1004, "one"), (1004, "one")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "'x' as h", "1 as shard", "'y' as ids", "2 as n_tokens")
    folder = str(tmp_path / "out")
    tokenbin.write(df, folder, TOKENIZER, by_words=True, planes=planes, shard_chars=20_000)
    made = tokenbin.manifest(folder)
    assert len(made["shards"]) > 2 and sum(s["docs"] for s in made["shards"]) == len(rows)
    assert sorted(os.listdir(folder)) == sorted(["manifest.json", *(s["file"] for s in made["shards"])])
    assert digest(tokenbin.read(spark, folder)) == expected(sorted(rows, key=lambda r: r[0]))


def test_ids_of_other_kinds(spark, tmp_path):
    rows = [("b", "two words"), (None, "first"), ("a", "x"), ("é", "last")]
    tokenbin.write(spark.createDataFrame(rows, "doc_id string, text string"), str(tmp_path / "s"), TOKENIZER, end_id=70_000)
    got = tokenbin.read(spark, str(tmp_path / "s"))
    assert [r.doc_id for r in sorted(got.collect(), key=lambda r: r.start)] == [None, "a", "b", "é"]
    assert {np.frombuffer(r.ids, "<u4")[-1] for r in got.collect()} == {70_000}
    # rows of one id follow their texts' hashes, however they are dealt out
    same = [(7, f"text {k % 5}") for k in range(40)]
    for n, name in ((1, "p"), (7, "q")):
        tokenbin.write(spark.createDataFrame(same, SCHEMA).repartition(n), str(tmp_path / name), TOKENIZER, shard_chars=50)
    assert digest(tokenbin.read(spark, str(tmp_path / "p"))) == digest(tokenbin.read(spark, str(tmp_path / "q")))


def test_an_id_with_very_many_rows_is_dealt_to_many_shards(spark, tmp_path):
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 5L, id) as doc_id", "repeat(if(id % 3 = 0, 'one text ', concat('text ', id, ' ')), 15) as text")
    tokenbin.write(df, str(tmp_path / "hot"), TOKENIZER, by_words=True, shard_chars=400_000)
    docs = [s["docs"] for s in tokenbin.manifest(str(tmp_path / "hot"))["shards"]]
    assert sum(docs) == 20_000 and max(docs) < 20_000 / 3 * 0.7


def test_empty_table(spark, tmp_path):
    tokenbin.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"), TOKENIZER)
    assert tokenbin.manifest(str(tmp_path / "none"))["shards"] == [] and tokenbin.read(spark, str(tmp_path / "none")).collect() == []
