"""Layer databases, table listings, previews, inline rows, Parquet extracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import folder_bytes

LAYERS = ("raw", "staging", "marts")


def create_layers(spark: SparkSession, root: str, prefix: str = "") -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer} LOCATION '{root}/{layer}'")


def write_version(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write a table whole to a new folder."""
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def point_to(spark: SparkSession, table: str, path: str) -> None:
    """Let a catalog table be the files of a folder from now on. A change of metadata alone: a query that
    runs goes on with the files it began with."""
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM parquet.`{path}`")


def list_tables(spark: SparkSession, prefix: str = "") -> DataFrame:
    """(table_schema, table_name) of all layers, ordered by name."""
    rows = [
        (layer, table.name)
        for layer in LAYERS
        for table in spark.catalog.listTables(f"{prefix}{layer}")
        if not table.isTemporary
    ]
    staged = [
        ("staging", table.name.removeprefix(f"{prefix}staging_"))
        for table in spark.catalog.listTables()
        if table.isTemporary and table.name.startswith(f"{prefix}staging_")
    ]
    return inline_rows(spark, rows + staged, "table_schema STRING, table_name STRING").orderBy(
        "table_name", "table_schema"
    )


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(n)


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row and column counts; the counts run as one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("long").alias("columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def layer_inventory(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """(layer, table_name, rows) of every table, raw first, then staging, then marts."""
    parts = [
        table_sizes(tables).select(F.lit(layer).alias("layer"), "table_name", "rows")
        for layer, tables in layers.items()
    ]
    position = F.array_position(F.array(*[F.lit(x) for x in LAYERS]), F.col("layer"))
    return reduce(DataFrame.unionByName, parts).orderBy(position, "table_name")


def write_extract(df: DataFrame, path: str) -> tuple[int, int]:
    """Write a ZSTD Parquet extract; return its rows, read back from the files, and its bytes."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path).count(), folder_bytes(spark, path)
