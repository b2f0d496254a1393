"""Session helpers: where shared files go, how lineage is cut, when a side may be broadcast."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if its files are proven to be smaller than this.
BROADCAST_LIMIT_BYTES = 8 * 1024 * 1024

_roots: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Unset with a local master (tests, one machine), a local one is made once and removed at the end; on a cluster it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not getattr(spark, "_noticeworks_dir", None):
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="noticeworks-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark._noticeworks_dir = "file://" + folder
    return spark._noticeworks_dir


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, below one folder per application: ``clear_scratch`` removes it, and so does the end of the driver."""
    root = f"{shared_dir(spark)}/noticeworks-{spark.sparkContext.applicationId}"
    if root not in _roots:
        _roots.add(root)
        atexit.register(_forget, spark, root)
    return f"{root}/{tag}-{uuid.uuid4().hex}"


def _forget(spark: SparkSession, root: str) -> None:
    try:
        delete(spark, root)
    except Exception:  # the session may have ended before; then clear_scratch of a later one does it
        pass


def clear_scratch(spark: SparkSession) -> None:
    """Removes all tables this application wrote to the shared folder; no DataFrame built on them can be used any more."""
    delete(spark, f"{shared_dir(spark)}/noticeworks-{spark.sparkContext.applicationId}")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object, so that any store Spark can read will do."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder, in order; none if there is no such folder."""
    fs, at = file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, written whole beside its place and then moved there."""
    fs, at = file_system(spark, path)
    _, beside = file_system(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    if fs.exists(at):
        fs.delete(at, False)
    if not fs.rename(beside, at):
        raise OSError(f"{path} could not be put in place")


def read_bytes(spark: SparkSession, path: str) -> bytes:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def written(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Removes tables of ``written`` that nothing reads any more, and the shuffle files of plans that are not used again.

    Spark removes those when the driver's JVM has found their plans to be garbage, which it would look for only when its memory is short.
    """
    for df in tables:
        for path in {name.split("/part-")[0] for name in df.inputFiles()}:
            delete(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def files_size(df: DataFrame) -> int | None:
    """Bytes of the files behind ``df``; None if they cannot be listed."""
    spark = df.sparkSession
    files = df.inputFiles()
    if not files:
        return None
    total = 0
    for name in files:
        fs, path = file_system(spark, name)
        total += fs.getFileStatus(path).getLen()
    return total


def small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its source files are proven small, else unchanged (a shuffled join follows)."""
    size = files_size(df)
    return F.broadcast(df) if size is not None and size <= limit else df


def partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
