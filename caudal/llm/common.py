"""Helpers that the corpus operators share.

Everything here is either a Column expression, an Arrow batch function, or a
way to cut lineage through the cluster's shared folder. Nothing keeps state on
an executor, so a lost executor only costs the re-run of its tasks.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The words of the query contracts: runs of anything but ASCII white space. bytes.split() cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or what SparkContext.setCheckpointDir got.

    Where neither is set, as in tests, a local master gets a folder of its own; on a cluster, whose machines would not see each other's, that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="caudal-"))
    return sc._jsc.sc().getCheckpointDir().get()


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it again: later stages neither recompute it nor lose it with an executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/caudal-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._caudal_path = path
    return out


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder's path in the shared folder, for files that are not tables; it is deleted when the driver ends."""
    path = f"{shared_folder(spark)}/caudal-{tag}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def discard(df: DataFrame) -> None:
    """Deletes what materialise() wrote, once nothing reads it any more."""
    path = getattr(df, "_caudal_path", None)
    if path:
        _delete(df.sparkSession, path)
        _written[:] = [x for x in _written if x[1] != path]


def _delete(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


@atexit.register
def _tidy() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # the session may be gone already; the folder is then the cluster's to clean
            return


class IdFilter:
    """A bitmap of hashed 64-bit ids. It has no false negatives; what it lets through in excess is for the join that follows to drop.

    16 to 32 bits for each id, but never over 2 ** MOST_BITS (16 MB, the proven bound of what travels); beyond, it only lets more through.
    """

    LEAST_BITS, MOST_BITS = 16, 27

    def __init__(self, ids: DataFrame) -> None:
        """ids: one long column."""
        c = F.col(ids.columns[0])
        n = ids.count()
        self.bits = min(self.MOST_BITS, max(self.LEAST_BITS, (16 * n).bit_length()))
        slot = F.pmod(F.xxhash64(c), F.lit(1 << self.bits))
        words = ids.select(slot.alias("s")).groupBy(F.shiftright("s", 5).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 32 as int))")).alias("bits")).toArrow()
        self.map = np.zeros(1 << (self.bits - 5), np.uint32)
        self.map[words.column("w").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)

    def slot(self, c: Column) -> Column:
        """What has() wants of an id."""
        return F.pmod(F.xxhash64(c), F.lit(1 << self.bits))

    def has(self, slots: np.ndarray) -> np.ndarray:
        return (self.map[slots >> 5] >> (slots & 31).astype(np.uint32)) & 1 == 1


def bucket_of(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def fresh(names: list[str], wanted: str) -> str:
    """wanted, or wanted with underscores, so that it clashes with none of names whatever their case."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def annotate(df: DataFrame, text: str, fn: Callable[[list], list[pa.Array]], fields: list[T.StructField]) -> tuple[DataFrame, list[str]]:
    """df with further columns that fn computes from the texts of an Arrow batch; also the names they got.

    fn gets a list of str or None and returns one Arrow array for each field.
    Columns of df that have such a name already are kept; the new ones then get underscores.
    """
    names: list[str] = []
    for f in fields:
        names.append(fresh(df.columns + names, f"_c_{f.name}"))
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, f.dataType, True) for n, f in zip(names, fields, strict=True))])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, at):
                new = fn(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *names])

    return df.mapInArrow(run, schema), names


def slices(b: pa.RecordBatch, at: int, rows: int = 512, most: int = 32_000_000) -> Iterator[pa.RecordBatch]:
    """b in pieces of so many rows, fewer where the texts are long: what a piece needs in memory stays bounded."""
    if b.num_rows == 0:
        return
    step = max(1, min(rows, int(rows * most / max(most, b.column(at).nbytes * rows / b.num_rows))))
    for i in range(0, b.num_rows, step):
        yield b.slice(i, step)


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered for the common ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each bit of the input changes about half of those of the output."""
    x = (x ^ (x >> np.uint64(30))) * M2
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB) ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all k-word shingles, in text order; the whole sequence as one if it is shorter."""
    n = len(hashes)
    if not n:
        return hashes
    m = max(1, n - k + 1)
    out = np.full(m, np.uint64(min(k, n)), np.uint64)
    for j in range(min(k, n)):
        out = mix(out * M1 + hashes[j : j + m])
    return out


def class_sample(rows: DataFrame, label: str, id_col: str, per_class: int, seed: int) -> DataFrame:
    """About per_class rows of each label at most, chosen by a hash of the id: the same rows at any partitioning.

    The share of each label comes from a count of all rows; only one number for each label reaches the driver.
    """
    counts = [(r[0], r[1]) for r in rows.groupBy(label).count().collect() if r[0] is not None]
    if not counts:
        return rows.limit(0)
    share = F.create_map(*[x for v, n in counts for x in (F.lit(v), F.lit(min(1.0, per_class / n)))])
    at = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(at < share[F.col(label)])


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
