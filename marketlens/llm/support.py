"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

REPOSITORY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def keep(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(df: DataFrame, bound: int) -> bool:
    """Whether a kept frame has at most `bound` rows."""
    return df.limit(bound + 1).count() <= bound


BROADCAST_BYTES = 32 << 20


def bytes_of(df: DataFrame) -> int:
    """About how much memory the values of a kept frame need; lists hold numbers or binaries."""
    size = F.lit(16)
    for field in df.schema.fields:
        kind, value = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(value), F.lit(0)) + 16
        elif isinstance(kind, T.ArrayType):
            size = size + F.greatest(F.size(value), F.lit(0)) * 16 + 16
        else:
            size = size + 16
    return df.agg(F.sum(size.cast("long"))).first()[0] or 0


def hint_if_small(df: DataFrame, bound: int = BROADCAST_BYTES) -> DataFrame:
    """A kept frame with a broadcast hint if it is proven small, else as it is: Spark then shuffles both
    sides."""
    return F.broadcast(df) if bytes_of(df) <= bound else df


ROWS_PER_BATCH = 1000  # of whole texts between the JVM and Python workers: some MB


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package when the session was started from another folder, and get
    texts in batches of a bounded number."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if REPOSITORY not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([REPOSITORY, *filter(None, paths)])


_held: dict = {}


def held(key, make):
    """The lookups of the operator that a Python worker works for: workers are used again, so asking for
    those of one operator gives up those of the one before."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def without(docs: DataFrame, rejected: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`docs` without the rejected rows (id, text_key): told apart by id and text, so null ids work too."""
    rejected = keep(rejected.select(F.col(id_col).alias("_id"), F.col("text_key").alias("_key")).distinct(), "rejected")
    # Their own columns travel in one of ours, so they may have any names.
    keyed = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), text_key(text_col).alias("key"))
    same = keyed["id"].eqNullSafe(rejected["_id"]) & (keyed["key"] == rejected["_key"])
    return keyed.join(hint_if_small(rejected), same, "left_anti").select("doc.*")


def crc32_sql(text: str) -> tuple[str, str]:
    """DuckDB SQL of the unsigned crc32 of a text's UTF-8 bytes: the definition of a table `crc_table` of
    one row that has to be in FROM, and the expression over it."""
    step = "xor(c >> 1, 3988292384 * (c & 1))"  # fixed value: the reflected polynomial of CRC-32
    table = f"""crc_table AS (
    SELECT list(v ORDER BY i) AS crc_steps FROM (
        SELECT i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: {step}) AS v FROM range(256) t(i)))"""
    byte = f"('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT"
    bytes_ = f"list_transform(range(strlen({text})), lambda k: {byte})"
    folded = f"list_reduce([4294967295::BIGINT] || {bytes_}, lambda c, b: xor(c >> 8, crc_steps[xor(c & 255, b) + 1]))"
    return table, f"xor({folded}, 4294967295)"
