"""Token ids in a bit-plane file format.

write() tokenises texts, ends each document with an id, deals the documents out
to shards by ascending doc_id and writes one file a shard; read() gives them back.

A file holds, one after another: MAGIC; the chunks; the index; the footer. A
chunk is a block of BLOCK ids (the file's last one may be shorter) as 32-bit
numbers, transposed: plane k of kind "bit" has bit k of every id, eight ids a
byte; of kind "byte" it has byte k of every id. Only planes up to the highest
bit set are stored, each compressed by zstandard. The index is two Arrow tables:
of the chunks (offset, n_ids, compressed length of each plane, crc32 of the ids
as little-endian 32-bit numbers) and of the documents (doc_id, start in the
file, n_tokens). A document may span chunks; a reader needs only those that it
touches. The footer has the lengths of both tables and MAGIC again.

A folder's manifest.json names the files that count, in order, with their
numbers of documents and ids. A task writes a file under a name of its own and
the driver writes the manifest when all are done, so a task that runs twice or
an executor that is lost leaves at most a file that no one reads.

Nulls and edge cases: a null or empty text is its end id alone. Null ids come
first, then ids in ascending order; rows that share an id follow the 64-bit
hashes of their texts. Identical rows may lie in different shards, so that an id
with very many rows makes no shard larger than others. An empty table gives a
manifest without files, and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
import sys
import types
import uuid
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import discard, materialise, slices

MAGIC = b"BITPLAN1"
BLOCK = 65_536
#: Characters of text that a shard holds, about; a table of few characters still gets a shard for each core.
SHARD_CHARS = 64 << 20
#: Marks that end a word of ASCII letters without joining its last token. No quote and no backslash: a quote may begin a suffix.
TAIL = '!"#$%&()*+,-./:;=>?@[]^_`{|}~'
#: Words of letters that composition leaves alone and of which each has one lower-case form.
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


# --- texts to ids ------------------------------------------------------------


class WordIds(dict):
    """Ids of words (runs of anything but ASCII white space), each made by the tokenizer once while it is remembered.

    Right for tokenizers that compose, drop white space, lower-case, and let no token join letters or digits with the
    marks after them, as word_bpe_49k does; a word's ids are then the same in any text. Words are cut into a core and
    its marks. A core of Latin letters passes all of that but case, so the model itself is asked, in the byte alphabet
    that such vocabularies are written in; other pieces go through the whole tokenizer.
    """

    #: Words, and pieces of words, that are remembered at once.
    MOST_WORDS, MOST_PIECES = 400_000, 1_200_000

    def __init__(self, tokenizer, dtype: str) -> None:
        super().__init__()
        self.tokenizer, self.dtype, self.kind = tokenizer, dtype, "H" if dtype == "<u2" else "I"
        self.pieces: dict[str, bytes] = {"": b""}
        # The byte alphabet: printable bytes stand for themselves, the others for the letters from U+0100 on, in order.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in shown]
        self.letters = {b: chr(256 + hidden.index(b)) for b in hidden}
        probe = ("the", "a", "zxqv", "internationalisation", "niño", "façade", "öäß")
        self.direct = all(self._model(w) == self._ids(tokenizer.encode(w, add_special_tokens=False).ids) for w in probe)

    def _ids(self, ids: list[int]) -> bytes:
        return array(self.kind, ids).tobytes()

    def _model(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return self._ids([t.id for t in self.tokenizer.model.tokenize(shown)])

    def learn(self, words: set[str]) -> None:
        cut, pieces, plain, other = [], self.pieces, set(), set()
        for w in words:
            core, tail = w, ""
            if "<" not in w:  # else it may hold a special token
                core = w.rstrip(TAIL)
                if LATIN(core):
                    tail, core = w[len(core) :], core.lower()
                    if core not in pieces:
                        plain.add(core)
                elif core[-1:].isascii() and core[-1:].isalnum():
                    tail = w[len(core) :]
                else:
                    core = w
            if core not in pieces and core not in plain:
                other.add(core)
            if tail not in pieces:
                other.add(tail)
            cut.append((w, core, tail))
        if self.direct:
            for p in plain:
                pieces[p] = self._model(p)
        else:
            other |= plain
        new = list(other)
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                pieces[p] = self._ids(e.ids)
        for w, a, b in cut:
            self[w] = pieces[a] + pieces[b]

    def of(self, words: list[str]) -> list[bytes]:
        """The ids of each of some different words."""
        if len(self) > self.MOST_WORDS:
            self.clear()
        if len(self.pieces) > self.MOST_PIECES:
            self.pieces = {"": b""}
        found = list(map(self.get, words))
        new = {w for w, x in zip(words, found, strict=True) if x is None} if None in found else ()
        if new:
            self.learn(new)
            found = list(map(self.__getitem__, words))
        return found


def _held() -> dict:
    """The tokenizer and the words that this process knows already, for the tasks that it runs one after another: only a cache.

    This package travels with each task, so its own globals do not last.
    """
    return sys.modules.setdefault("caudal_held", types.SimpleNamespace(tokenizers={})).tokenizers


def encoder(tokenizer_json: str, end_id: int, by_words: bool) -> tuple[Callable[[pa.Array], pa.Array], str]:
    """A function from an Arrow array of texts to their ids as binary, and the ids' numpy type: two bytes where the vocabulary allows."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    held = _held()
    name = (zlib.crc32(tokenizer_json.encode()), len(tokenizer_json))
    if name not in held:
        held.clear()  # one tokenizer at a time
        held[name] = [Tokenizer.from_str(tokenizer_json), None]
    tokenizer = held[name][0]
    dtype = "<u2" if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    end = np.array([end_id], dtype)
    if not by_words:
        return lambda texts: pa.array([np.array([*e.ids, end_id], dtype).tobytes() for e in tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)], pa.binary()), dtype
    if held[name][1] is None or held[name][1].dtype != dtype:
        held[name][1] = WordIds(tokenizer, dtype)
    ids = held[name][1]

    def encode(texts: pa.Array) -> pa.Array:
        """Each different word of the batch is looked up once; the rest is gathering by arrays."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        parts = ids.of(coded.dictionary.to_pylist())
        flat = np.concatenate([np.frombuffer(b"".join(parts), dtype), end])
        sizes = np.append(np.fromiter(map(len, parts), np.int64, len(parts)) // end.itemsize, 1)
        starts = np.cumsum(sizes) - sizes
        words = np.insert(coded.indices.to_numpy().astype(np.int64), offsets[1:], len(parts))  # each text's end id as a word
        n = sizes[words]
        ends = np.cumsum(n)
        data = flat[np.repeat(starts[words] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        of_text = np.concatenate([[0], ends[offsets[1:] + np.arange(len(texts))]]) if len(texts) else np.zeros(1)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((of_text * end.itemsize).astype(np.int32)), pa.py_buffer(data)])

    return encode, dtype


# --- blocks and planes -------------------------------------------------------


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block of ids (uint32), lowest first, up to the highest bit set."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        wide = (int(ids.max(initial=0)).bit_length() + 7) // 8
        return [rows[:, k].tobytes() for k in range(wide)]
    wide = int(ids.max(initial=0)).bit_length()
    bits = np.unpackbits(rows, axis=1, bitorder="little")[:, :wide]
    return [p.tobytes() for p in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    if kind == "byte":
        for k, p in enumerate(planes):
            out[:, k] = np.frombuffer(p, np.uint8)
    elif planes:
        bits = np.zeros((n, 32), np.uint8)
        for k, p in enumerate(planes):
            bits[:, k] = np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little")
        out = np.packbits(bits, axis=1, bitorder="little")
    return out.reshape(-1).view("<u4")


class ShardWriter:
    """Writes one file; add() takes documents in their order."""

    def __init__(self, sink, kind: str = "bit", block: int = BLOCK, level: int = 3) -> None:
        import zstandard

        self.sink, self.kind, self.block, self.zip = sink, kind, block, zstandard.ZstdCompressor(level)
        self.at, self.n, self.rest = sink.write(MAGIC), 0, np.empty(0, np.uint32)
        self.chunks: list[tuple] = []
        self.docs: list[pa.RecordBatch] = []

    def add(self, doc_ids: pa.Array, ids: list[np.ndarray]) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        starts = self.n + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.docs.append(pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(sizes)], names=["doc_id", "start", "n_tokens"]))
        self.n += int(sizes.sum())
        self.rest = np.concatenate([self.rest, *ids]).astype(np.uint32, copy=False)
        whole = len(self.rest) // self.block * self.block
        for i in range(0, whole, self.block):
            self._chunk(self.rest[i : i + self.block])
        self.rest = self.rest[whole:].copy()

    def _chunk(self, ids: np.ndarray) -> None:
        parts = [self.zip.compress(p) for p in to_planes(ids, self.kind)]
        self.chunks.append((self.at, len(ids), [len(p) for p in parts], zlib.crc32(ids.astype("<u4").tobytes())))
        for p in parts:
            self.at += self.sink.write(p)

    def close(self) -> None:
        if len(self.rest):
            self._chunk(self.rest)
        columns = list(zip(*self.chunks, strict=True)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int64())
        chunks = pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["offset", "n_ids", "sizes", "crc32"])
        chunks = chunks.replace_schema_metadata({"kind": self.kind, "block": str(self.block)})
        packed = [self.zip.compress(_ipc(t)) for t in (chunks, pa.Table.from_batches(self.docs))]
        for p in packed:
            self.sink.write(p)
        self.sink.write(struct.pack("<qq", *map(len, packed)) + MAGIC)


def _ipc(table: pa.Table) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema) as w:
        w.write_table(table)
    return out.getvalue()


class ShardReader:
    """Reads one file; documents() gives those of a range of rows of its index, whose chunks alone are read."""

    def __init__(self, file) -> None:
        import zstandard

        self.file, self.unzip = file, zstandard.ZstdDecompressor()
        end = file.seek(0, 2) or file.tell()
        file.seek(end - 24)
        foot = file.read(24)
        if foot[16:] != MAGIC:
            raise ValueError("not a bit-plane file, or a broken one")
        a, b = struct.unpack("<qq", foot[:16])
        file.seek(end - 24 - a - b)
        self.chunks, self.docs = (pa.ipc.open_stream(self.unzip.decompress(file.read(n))).read_all() for n in (a, b))
        meta = self.chunks.schema.metadata
        self.kind, self.block = meta[b"kind"].decode(), int(meta[b"block"])
        self.held: tuple[int, np.ndarray] = (-1, np.empty(0, np.uint32))

    def chunk(self, i: int) -> np.ndarray:
        if self.held[0] != i:
            offset, n, sizes, crc = (c[i].as_py() for c in self.chunks.columns)
            self.file.seek(offset)
            ids = from_planes([self.unzip.decompress(self.file.read(k)) for k in sizes], n, self.kind)
            if zlib.crc32(ids.tobytes()) != crc:
                raise ValueError(f"chunk {i} differs from its crc32")
            self.held = (i, ids)
        return self.held[1]

    def ids(self, start: int, n: int) -> np.ndarray:
        first, last = start // self.block, max(start, start + n - 1) // self.block
        parts = [self.chunk(i)[max(0, start - i * self.block) : start + n - i * self.block] for i in range(first, last + 1)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def documents(self, rows: int = 1024, most: int = 4 << 20) -> Iterator[tuple[pa.Table, list[bytes]]]:
        """Index rows and their ids as little-endian 32-bit numbers, in batches of at most so many rows and about so many ids."""
        starts, sizes = (self.docs.column(c).to_numpy() for c in ("start", "n_tokens"))
        at = 0
        while at < len(sizes):
            n = max(1, min(rows, int(np.searchsorted(np.cumsum(sizes[at : at + rows]), most))))
            yield self.docs.slice(at, n), [self.ids(int(s), int(k)).tobytes() for s, k in zip(starts[at : at + n], sizes[at : at + n], strict=True)]
            at += n


# --- the format as a data source ----------------------------------------------


def _place(path: str):
    """A file system and the path in it; a path without a scheme is a local or mounted one."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Written(WriterCommitMessage):
    def __init__(self, shard: int, file: str | None, docs: int, ids: int) -> None:
        self.shard, self.file, self.docs, self.ids = shard, file, docs, ids


class PlanesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType) -> None:
        self.path, self.kind, self.block = options["path"], options.get("planes", "bit"), int(options.get("block", BLOCK))
        self.dtype, self.id_type = options.get("ids", "<u4"), schema["doc_id"].dataType.json()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        shard, writer, docs, fs, base = TaskContext.get().partitionId(), None, 0, *_place(self.path)
        name, sink = f"shard-{shard:08d}-{uuid.uuid4().hex}.planes", None
        for b in iterator:
            if not b.num_rows:
                continue
            if writer is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(f"{base}/{name}")
                writer = ShardWriter(sink, self.kind, self.block)
            at = b.schema.get_field_index("ids")
            for part in slices(b, at):
                writer.add(part.column(part.schema.get_field_index("doc_id")), [np.frombuffer(x.as_buffer(), self.dtype) for x in part.column(at)])
                docs += part.num_rows
        if writer is None:
            return Written(shard, None, 0, 0)
        writer.close()
        sink.close()
        return Written(shard, name, docs, writer.n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, base = _place(self.path)
        fs.create_dir(base, recursive=True)
        shards = sorted((m for m in messages if m and m.file), key=lambda m: m.shard)
        made = {"doc_id": self.id_type, "shards": [{"file": m.file, "docs": m.docs, "ids": m.ids} for m in shards]}
        with fs.open_output_stream(f"{base}/manifest.new") as out:
            out.write(json.dumps(made).encode())
        fs.move(f"{base}/manifest.new", f"{base}/manifest.json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, base = _place(self.path)
        for m in messages:
            if m and m.file:
                fs.delete_file(f"{base}/{m.file}")


class Shard(InputPartition):
    def __init__(self, file: str | None, before: int) -> None:
        super().__init__(before)
        self.file, self.before = file, before


class PlanesReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType) -> None:
        self.path, self.schema = path, schema

    def partitions(self) -> list[InputPartition]:
        shards, before = [], 0
        for s in manifest(self.path)["shards"]:
            shards.append(Shard(s["file"], before))
            before += s["ids"]
        return shards or [Shard(None, 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.file is None:
            return
        fs, base = _place(self.path)
        with fs.open_input_file(f"{base}/{partition.file}") as file:
            for index, ids in ShardReader(file).documents():
                index = index.combine_chunks().to_batches()[0]
                start = pa.array(index.column(1).to_numpy() + partition.before)
                yield pa.RecordBatch.from_arrays([index.column(0), start, index.column(2), pa.array(ids, pa.binary())], names=self.schema.names)


class PlanesSource(DataSource):
    """spark.dataSource.register(PlanesSource), then format("bitplanes"). Options: path; to write, planes (bit or byte), block, and ids, the numpy type of the column ids."""

    @classmethod
    def name(cls) -> str:
        return "bitplanes"

    def schema(self) -> T.StructType:
        kind = T._parse_datatype_json_string(manifest(self.options["path"])["doc_id"])
        return T.StructType().add("doc_id", kind).add("start", "long").add("n_tokens", "long").add("ids", "binary")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PlanesReader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return PlanesWriter(dict(self.options), schema)


def manifest(path: str) -> dict:
    fs, base = _place(path)
    with fs.open_input_stream(f"{base}/manifest.json") as f:
        return json.loads(f.read())


# --- the operator --------------------------------------------------------------


def bounds(keys: DataFrame, shards: int) -> list[tuple]:
    """The first key of each shard but the first, for shards of about as many characters. keys: doc_id, h, s, chars."""
    keys = keys.withColumn("copies", F.expr("sequence(0, cast(chars div 65536 as int))")).select("doc_id", "h", "s", F.explode("copies").alias("copy"))  # a long text counts for as many short ones
    order = [F.col("doc_id").asc_nulls_first(), "h", "s", "copy"]
    first = keys.repartitionByRange(shards, *order).groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "h", "s")).alias("k"))
    return sorted((_key(r.k.doc_id, r.k.h, r.k.s) for r in first.collect()))[1:]


def _key(doc_id, h: int, s: int) -> tuple:
    return (0, h, s) if doc_id is None else (1, doc_id, h, s)


def write(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 1, by_words: bool = False, planes: str = "bit", block: int = BLOCK, shard_chars: int = SHARD_CHARS) -> None:
    """Writes the ids of docs (doc_id, text) to the folder path.

    tokenizer: path of a file of the tokenizers library, read by the driver. by_words: as WordIds says.
    The driver keeps a key for each shard, nothing for documents.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumns({"h": F.xxhash64("text"), "s": F.xxhash64(F.monotonically_increasing_id())})
    keys = materialise(docs.select("doc_id", "h", "s", F.length("text").cast("long").alias("chars")), "ids-keys")
    total = keys.agg(F.sum("chars")).first()[0] or 0
    cuts = bounds(keys, max(1, min(-(-total // shard_chars) + spark.sparkContext.defaultParallelism, 1 + total // 100_000)))
    discard(keys)
    dtype = encoder(spec, end_id, by_words)[1]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, _ = encoder(spec, end_id, by_words)
        for b in batches:
            for part in slices(b, 1, 2048):
                doc_id, text, h, s = part.columns
                shard = [bisect_right(cuts, _key(*k)) for k in zip(doc_id.to_pylist(), h.to_pylist(), s.to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([doc_id, h, pa.array(shard, pa.int32()), of(text)], names=["doc_id", "h", "shard", "ids"])

    schema = T.StructType([docs.schema["doc_id"], *T.StructType().add("h", "long").add("shard", "integer").add("ids", "binary").fields])
    dealt = docs.mapInArrow(encode, schema).repartitionById(len(cuts) + 1, "shard").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h").select("doc_id", "ids")
    spark.dataSource.register(PlanesSource)
    dealt.write.format("bitplanes").option("path", path).option("planes", planes).option("block", block).option("ids", dtype).mode("append").save()


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian 32-bit numbers) of each document of the folder."""
    spark.dataSource.register(PlanesSource)
    return spark.read.format("bitplanes").option("path", path).load()
