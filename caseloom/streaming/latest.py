"""The last record of every ticket, kept up to date from a stream of raw files (SRC-3, SRC-4).

A ticket's record may be sent again, corrected, or late. The stream keeps one row of state per ticket id: the record
with the greatest created_at (then the greatest content, so any order of arrival gives the same answer). Tickets whose
row changed in a micro-batch replace theirs in the stored table, which lies in folders by bucket of ticket id; only the
buckets concerned are written. State and progress lie in the checkpoint folder under the root: a stream that is started
again goes on where it ended, and a micro-batch that is run twice writes the same rows. Equals ``latest_tickets`` over
all files at once. A null id counts as one ticket; a record without created_at yields to any that has one.

For many tickets set ``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB provider, which keeps state on disk.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from caseloom.config import PipelineConfig, materialize
from caseloom.operators import standardize
from caseloom.schemas import RAW_SCHEMAS

BUCKET = "ticket_bucket"


def latest_tickets(tickets: DataFrame) -> DataFrame:
    """One row per ticket id: its last record."""
    order = F.struct("created_at", *[c for c in tickets.columns if c != "created_at"])
    return tickets.groupBy(F.col("ticket_id").alias("_id")).agg(F.max_by(F.struct(*tickets.columns), order).alias("_r")).select("_r.*")


def replace_tickets(changed: DataFrame, path: str, buckets: int) -> None:
    """Put the rows of ``changed`` (one per ticket id) in place of theirs in the table at ``path``."""
    spark = changed.sparkSession
    changed = materialize(changed.withColumn(BUCKET, F.pmod(F.xxhash64("ticket_id"), F.lit(buckets)).cast("int")))
    touched = sorted(r[0] for r in changed.select(BUCKET).distinct().collect())  # at most ``buckets``
    if not touched:
        return
    try:
        stored = spark.read.parquet(path).where(F.col(BUCKET).isin(touched))
        ids = changed.select(F.col("ticket_id").alias("_now"))
        kept = stored.join(ids, F.col("ticket_id").eqNullSafe(F.col("_now")), "left_anti")
        changed = materialize(kept.select(*changed.columns).unionByName(changed))  # before the folders it reads are replaced
    except AnalysisException as e:  # the first rows of the table
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    changed.repartition(BUCKET, F.xxhash64("ticket_id")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def start_latest_tickets(spark: SparkSession, cfg: PipelineConfig, buckets: int = 16, available_now: bool = True,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """The stream over the raw support tickets into silver/latest_tickets."""
    reader = spark.readStream.schema(RAW_SCHEMAS["support_tickets"]).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    typed = standardize.standardize_tickets(reader.json(cfg.path("raw", "support_tickets")))
    path = cfg.path("silver", "latest_tickets")
    writer = latest_tickets(typed).writeStream.outputMode("update").foreachBatch(
        lambda changed, _: replace_tickets(changed, path, buckets)).option(
        "checkpointLocation", f"{cfg.root.rstrip('/')}/_checkpoints/latest_tickets")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
