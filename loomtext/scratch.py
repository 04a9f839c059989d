"""Tables written to the folder that driver and executors share: they cut lineage and fix what a partition held."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: dict[str, SparkSession] = {}
_path_of: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in spark.checkpoint.dir.

    Where it names none, a local session gets a temporary folder; on a cluster, where executors could not read
    that, it is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loomtext-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def claim(spark: SparkSession, name: str) -> str:
    """A path under the shared folder, whose files go when the driver ends."""
    path = f"{shared_folder(spark)}/loomtext/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_clean)
    _written[path] = spark
    return path


def stash(df: DataFrame, tag: str, by: Sequence[str] = ()) -> DataFrame:
    """Write df to the shared folder and read it again.

    Later stages then depend on files instead of on tasks of lost executors, and what a partition
    or a row number was when it was written stays so. The files go when the driver ends, or with `release`.
    """
    spark = df.sparkSession
    path = claim(spark, tag)
    writer = df.write.option("compression", "zstd")
    # what the write shuffles is deleted with it, not when the driver happens to collect garbage
    kept = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        (writer.partitionBy(*by) if by else writer).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, kept)
    back = spark.read.schema(df.schema).parquet(path)
    _path_of[back] = path
    return back


def release(*stashed: DataFrame) -> None:
    """Delete tables that `stash` gave and that nothing reads any more."""
    for df in stashed:
        if path := _path_of.pop(df, None):
            _delete(path, _written.pop(path))


def _delete(path: str, spark: SparkSession) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).delete(at, True)


def _clean() -> None:
    for path, spark in _written.items():
        try:
            _delete(path, spark)
        except Exception:  # noqa: BLE001 - the session may already be gone; the files are only scratch
            return


def width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
