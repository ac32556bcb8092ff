"""Writers (SNK-1..4) with row counts observed at write time (AGG-8).

Stored layers are Parquet, written in parallel (no forced single file). CSV and
JSON-lines writers exist for export; ``single_file=True`` is only for small
outputs such as the aggregates (it funnels the last stage into one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> int:
    """Write a stored layer as Parquet; returns the rows written (no second scan)."""
    out, obs = _observed(df, f"write:{path}")
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get["rows"])


def replace_partitions(df: DataFrame, path: str, key: str, values: list) -> int:
    """Write ``df`` in place of the folders ``key=value`` of a partitioned table; all other folders stay untouched.

    ``values`` are the keys ``df`` stands for. A stored one without rows in ``df`` is an error, as its folder would stay."""
    stored = df.sparkSession.read.parquet(path).where(F.col(key).isin(values)).select(key).distinct()
    gone = stored.join(df.select(F.col(key).alias("_now")).distinct(), F.col(key) == F.col("_now"), "left_anti").collect()  # at most ``values``
    if gone:
        raise ValueError(f"no rows are left for {key} {sorted(r[0] for r in gone)}: rebuild {path}")
    out, obs = _observed(df, f"replace:{path}")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    return int(obs.get["rows"])


def write_bucketed_table(df: DataFrame, table: str, path: str, key: str, buckets: int) -> int:
    """A catalog table over ``path``, bucketed and sorted by ``key``: later
    joins and aggregations on ``key`` read it without a shuffle."""
    out, obs = _observed(df, f"bucketed:{table}")
    (out.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return int(obs.get["rows"])


def export_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> int:
    """SNK-1: headered CSV; quotes are escaped by doubling, so free text with
    commas, quotes and line breaks reads back with ``multiLine``."""
    out, obs = _observed(df.coalesce(1) if single_file else df, f"csv:{path}")
    (out.write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", False)
     .csv(path))
    return int(obs.get["rows"])


def export_json(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """SNK-2/SNK-3: JSON lines; null fields are written (readers index keys)."""
    out, obs = _observed(df, f"json:{path}")
    out.write.mode(mode).option("ignoreNullFields", False).json(path)
    return int(obs.get["rows"])


def write_text(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> int:
    """SNK-4: a one-row text frame (the brief) as one text file."""
    out, obs = _observed(df.select(F.col(column).alias("value")).coalesce(1), f"text:{path}")
    out.write.mode(mode).text(path)
    return int(obs.get["rows"])
