"""Readers for the raw and stored layers (SRC-1..4, SRC-2).

Raw files are read with an explicit all-text schema (header names checked, not
inferred), so an empty folder still yields the right columns (SEM-16) and bad
cells are left for the typed casts in ``standardize`` to null out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.schemas import RAW_SCHEMAS


# header names must match the schema; quotes inside quoted cells are doubled
CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "escape": '"'}
_CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """SRC-1: a folder of headered CSV files, every column text.

    ``multi_line=True`` for files whose quoted cells contain line breaks
    (SEM-21); it makes each file one split, so keep it off for plain tables."""
    return (
        spark.read.schema(RAW_SCHEMAS[table])
        .options(**CSV_OPTIONS)
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_raw_json(spark: SparkSession, path: str, table: str = "support_tickets",
                  mode: str = "FAILFAST") -> DataFrame:
    """SRC-3/SRC-4: a folder of JSON-lines files; blank lines are skipped.

    ``FAILFAST`` aborts on a malformed line, as the source does; pass
    ``PERMISSIVE`` to keep going with null rows instead."""
    return spark.read.schema(RAW_SCHEMAS[table]).option("mode", mode).json(path)


def read_with_quarantine(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """A raw folder as (good, bad): rows that fit the schema, and the others as they stand with their file.

    Bad are CSV rows with too few or too many cells or an unclosed quote, and lines that are no JSON object. Every row
    (but headers and blank lines) is in one of the two. ``bad``: source_table, file, record. All columns are parsed even
    where a query needs few, or a row's fault would depend on the query.
    """
    schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField(_CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    if table == "support_tickets":
        rows = reader.option("multiLine", multi_line).json(path)
    else:
        rows = reader.options(**CSV_OPTIONS).option("columnPruning", "false").option("multiLine", multi_line).csv(path)
    columns = RAW_SCHEMAS[table].names
    # the condition holds for every row; it keeps all columns in the scan
    rows = rows.select(*columns, _CORRUPT, F.col("_metadata.file_path").alias("_file")).where(F.length(F.concat_ws("", *columns)) >= 0)
    good = rows.where(F.col(_CORRUPT).isNull()).select(*columns)
    bad = rows.where(F.col(_CORRUPT).isNotNull()).select(
        F.lit(table).alias("source_table"), F.col("_file").alias("file"), F.col(_CORRUPT).alias("record"))
    return good, bad


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: a stored (Parquet) layer; types survive, nothing is re-cast."""
    return spark.read.parquet(path)
