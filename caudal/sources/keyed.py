"""Keyed Parquet tables: upserts that rewrite only the buckets they touch, committed optimistically.

A table is a folder of manifests and of data. A row lies in a bucket by a hash of
its key; a manifest names, for each bucket, the run whose files hold it. An
upsert reads and writes the buckets of its own keys, then creates the next
manifest, which fails if another writer has created it meanwhile: as atomic as
the store's create-without-overwrite is. If the other writer touched other
buckets, this one's go on top of its manifest; else the rows are merged again.
Readers take the newest manifest and never see half an upsert.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import upsert
from ..operators.relational import keep_last
from ..operators.windows import global_ids
from ..shared import cut, drop

BUCKETS = 64


class Conflict(RuntimeError):
    """Other writers were faster at every attempt."""


class Store:
    """What is needed of Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path, self.jvm = path.rstrip("/"), spark.sparkContext._jvm
        self.fs = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        return [f.getPath().getName() for f in self.fs.listStatus(self.at(folder))] if self.fs.exists(self.at(folder)) else []

    def read(self, name: str) -> dict:
        stream = self.fs.open(self.at(name))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def create(self, name: str, value: dict) -> bool:
        """False if there is such a file."""
        try:
            stream = self.fs.create(self.at(name), False)
        except Py4JJavaError:
            if self.fs.exists(self.at(name)):
                return False
            raise
        try:
            stream.write(json.dumps(value).encode())
        finally:
            stream.close()
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _file(version: int) -> str:
    return f"_manifests/{version:010d}.json"


def _versions(store: Store) -> list[int]:
    return sorted(int(n[:-5]) for n in store.names("_manifests") if n.endswith(".json") and n[:-5].isdigit())


def current_version(spark: SparkSession, path: str) -> int:
    """The newest version of a keyed table, 0 if there is none."""
    return max(_versions(Store(spark, path)), default=0)


def _rows(spark: SparkSession, path: str, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(manifest["schema"])
    paths = [f"{path.rstrip('/')}/data/{run}/_bucket={b}" for b, run in manifest["at"].items() if buckets is None or int(b) in buckets]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a keyed table."""
    version = current_version(spark, path)
    if not version:
        raise FileNotFoundError(f"no table in {path}")
    return _rows(spark, path, Store(spark, path).read(_file(version)))


def _bucket(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(n)).cast("int")


def write_upsert(df: DataFrame, path: str, key: str, *, keep: int = 2, identity: str | None = None, order: str | None = None, buckets: int = BUCKETS, attempts: int = 5) -> int:
    """SNK6, SNK7, SNK8, SNK10 and SNK21: df's rows into a keyed table, each in place of that of its key; the number of the new version.

    Of several rows of a key in df the one of the greatest `order` counts (else any). With `identity`, a key keeps the
    number that the table has for it, and new keys get numbers that go on from the greatest (SNK8). Columns that one
    side lacks are null. `buckets` counts for a new table; the manifest and the list of touched buckets are what the
    driver sees. Files that none of the last `keep` versions uses go.
    """
    spark, store = df.sparkSession, Store(df.sparkSession, path)
    new = keep_last(df, [key], order) if order else df.dropDuplicates([key])
    new = cut(new.drop(identity) if identity else new, "upsert")  # merged again alike, should another writer be faster
    touched: list[int] | None = None
    for _ in range(attempts):
        version = max(_versions(store), default=0)
        old = store.read(_file(version)) if version else {"buckets": buckets, "at": {}, "last": 0, "schema": None}
        n = old["buckets"]
        if touched is None:
            touched = [r[0] for r in new.select(_bucket(key, n).alias("b")).distinct().collect()]
        stored = _rows(spark, path, old, touched) if version else None
        rows = _numbered(new, stored, key, identity, old["last"]) if identity else new
        rows = upsert(stored, rows, key) if version else rows
        run = uuid.uuid4().hex
        rows.withColumn("_bucket", _bucket(key, n)).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{store.path}/data/{run}")
        mine = {str(b): run for b in touched}
        made = {"buckets": n, "schema": json.loads(rows.schema.json()), "last": old["last"]}
        if identity and touched:
            made["last"] = max(old["last"], _rows(spark, path, {**made, "at": mine}).agg(F.max(identity)).first()[0] or 0)
        while True:
            made["at"] = {**old["at"], **mine}
            if store.create(_file(version + 1), made):
                drop(new)
                _tidy(store, keep)
                return version + 1
            # Another writer was faster. Where it left this one's buckets alone, these go on top of what it wrote.
            version = max(_versions(store))
            newer = store.read(_file(version))
            if identity or newer["schema"] != old["schema"] or newer["buckets"] != n or any(newer["at"].get(str(b)) != old["at"].get(str(b)) for b in touched):
                store.delete(f"data/{run}")
                break
            old = newer
    raise Conflict(f"{attempts} attempts to write to {path} met other writers")


def _numbered(new: DataFrame, stored: DataFrame | None, key: str, identity: str, last: int) -> DataFrame:
    known = new.join(stored.select(key, identity), key, "left") if stored is not None else new.withColumn(identity, F.lit(None).cast("long"))
    fresh = global_ids(known.where(F.col(identity).isNull()).drop(identity), [key], identity, last)
    return known.where(F.col(identity).isNotNull()).unionByName(fresh)


def _tidy(store: Store, keep: int) -> None:
    """Deletes manifests before the last `keep` ones, and the buckets that only they named."""
    versions = _versions(store)
    gone, stay = [store.read(_file(v))["at"] for v in versions[:-keep]], [store.read(_file(v))["at"] for v in versions[-keep:]]
    used = {(b, run) for at in stay for b, run in at.items()}
    for b, run in {(b, run) for at in gone for b, run in at.items()} - used:
        store.delete(f"data/{run}/_bucket={b}")
    for run in {run for at in gone for run in at.values()} - {run for _, run in used}:
        store.delete(f"data/{run}")
    for v in versions[:-keep]:
        store.delete(_file(v))
