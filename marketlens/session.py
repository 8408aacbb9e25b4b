"""Session settings the operators rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Runtime SQL settings: UTC for zone-free timestamps, AQE with skew-join splitting."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a hot join key even when the split costs one more exchange downstream.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Judge broadcast candidates by their size in memory, not by the compressed files.
    spark.conf.set("spark.sql.sources.fileCompressionFactor", "4.0")
    # Once every partition of a join side is measured to be this small, hash it instead of sorting
    # both sides.
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "32MB")
    return spark


# Compressed input per shuffle partition. Joins and windows sort rows that take about ten times as much
# memory, so this much still sorts in the memory of one task without a spill.
BYTES_PER_SHUFFLE_PARTITION = 16 * 1024 * 1024

# Of everything written to the shared folder.
CODEC = "zstd"


def _hadoop_path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_bytes(spark: SparkSession, folder: str) -> int:
    path, files = _hadoop_path(spark, folder)
    return files.getContentSummary(path).getLength()


def fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Tells two states of a folder of tables apart: name, time, bytes and files of each table in it."""
    path, files = _hadoop_path(spark, folder)
    if not files.exists(path):
        return ()

    def of(status) -> tuple:
        entry = status.getPath()
        held = files.getContentSummary(entry) if status.isDirectory() else None
        size = (held.getLength(), held.getFileCount()) if held else (status.getLen(), 1)
        return (entry.getName(), status.getModificationTime(), *size)

    return tuple(sorted(map(of, files.listStatus(path))))


def counting_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that counts the rows of Parquet tables from their footers."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder, in order; none if it does not exist."""
    path, files = _hadoop_path(spark, folder)
    if not files.exists(path):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(path) if f.isDirectory())


def make_folder(spark: SparkSession, folder: str) -> None:
    path, files = _hadoop_path(spark, folder)
    files.mkdirs(path)


def remove(spark: SparkSession, folder: str) -> None:
    path, files = _hadoop_path(spark, folder)
    files.delete(path, True)


def size_shuffles(spark: SparkSession, folder: str) -> None:
    """Raise the number of shuffle partitions to fit the input; AQE merges those that stay small."""
    size = folder_bytes(spark, folder)
    wanted = -(-size // BYTES_PER_SHUFFLE_PARTITION)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", wanted)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in spark.checkpoint.dir."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        folder = tempfile.mkdtemp(prefix="marketlens-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_dirs[context.applicationId] = folder
    return _local_dirs[context.applicationId]


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/marketlens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete everything this application wrote to the shared folder; for the end of a job."""
    remove(spark, _scratch_root(spark))


def stash(df: DataFrame, label: str = "stash") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage durably: a lost executor re-reads the files, so rows keep the placement they
    were written with.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
