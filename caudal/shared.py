"""Cutting lineage through the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_cut: list[DataFrame] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or what SparkContext.setCheckpointDir got; a local master without either, as in tests, gets a folder of its own, a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="caudal-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, tag: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: what follows neither recomputes it nor loses it with an executor."""
    path = f"{shared_folder(df.sparkSession)}/caudal-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._caudal_path = path
    _cut.append(out)
    return out


def drop(df: DataFrame) -> None:
    """Deletes what cut() wrote, once nothing reads it any more; what is left goes at the end of the driver."""
    path = getattr(df, "_caudal_path", None)
    _cut[:] = [x for x in _cut if x is not df]
    if path:
        spark = df.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _tidy() -> None:
    for df in list(_cut):
        try:
            if df.sparkSession.sparkContext._jsc is not None:
                drop(df)
        except Exception:  # the session may be gone already; the folder is then the cluster's to clean
            return
