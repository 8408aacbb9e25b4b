"""CSV source: declared schemas, quoted line breaks in any value, clear error for a missing file.

Files of any size are read in byte ranges by many tasks. Where no value holds a line break, Spark's reader
takes them line by line; else the ranges are scanned for quotes first and records put together."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv_records import Layout, records, text_lines
from .schemas import RAW_SCHEMAS, default_files


# A row with too few or too many fields fails, whichever of them a query needs. A value that cannot be
# read fails where its column is read: loading stores whole tables, so it reads all.
FORMAT = {"mode": "FAILFAST", "quote": '"', "escape": '"', "timestampNTZFormat": "yyyy-MM-dd[ HH:mm:ss]"}


def read_csv_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    declared = T.StructType.fromDDL(RAW_SCHEMAS[table])
    reader = spark.read.options(**FORMAT).option("header", True).option("columnPruning", False).option("enforceSchema", False)
    try:
        header = reader.csv(path).columns
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition() or ""):
            raise FileNotFoundError(f"missing input for table {table}: {path}") from error
        raise
    known = {f.name: f for f in declared.fields}
    missing = [name for name in known if name not in header and name not in OPTIONAL_COLUMNS]
    if missing:
        raise ValueError(f"table {table} lacks columns {missing}: {path}")
    # Read in file order; columns we do not know stay text.
    schema = T.StructType([known.get(h, T.StructField(h, T.StringType())) for h in header])
    lines = text_lines(spark, path)
    layout = Layout(lines)
    if layout.spans:
        for head in layout.heads:
            if next(csv.reader([head])) != header:
                raise ValueError(f"MALFORMED: files of table {table} differ in their columns: {path}")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parsed = F.from_csv("record", ddl, {**FORMAT, "multiLine": "true"})
        df = records(lines, layout).select(parsed.alias("row")).select("row.*")
    else:
        df = reader.schema(schema).csv(path)
    absent = [f for f in declared.fields if f.name not in header]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])


OPTIONAL_COLUMNS = {"geolocation_city", "geolocation_state", "review_comment_title"}


def load_raw(
    spark: SparkSession, folder: str, files: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """All nine raw tables of a folder; a missing file raises FileNotFoundError naming it."""
    files = files or default_files()
    return {
        table: read_csv_table(spark, f"{folder.rstrip('/')}/{name}", table)
        for table, name in files.items()
    }
