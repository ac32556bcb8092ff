"""Pipeline parameters and the Spark session the library expects."""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class PipelineConfig:
    """Where each layer lives and the few knobs the jobs take.

    ``root`` is a shared folder (object store or distributed file system on a
    cluster); every layer is a Parquet folder below it.
    """

    root: str
    raw: str = "raw"
    silver: str = "silver"
    model: str = "model"
    gold: str = "gold"
    database: str = "retail_support"
    top_n: int = 3
    delay_hours_threshold: float = 24.0
    brief_limit: int = 10
    embedding_dim: int = 64
    similarity_block_rows: int = 100_000
    # write orders, shipments and returns bucketed by order_id into this many
    # buckets (catalog tables): the 360 joins then read co-partitioned inputs
    order_buckets: int | None = None
    hot_key_rows: int | None = 1_000_000  # rows of one order that one task may join
    raw_root: str | None = None  # where the raw layer lies if not under ``root`` (runs have a root of their own)
    # keep raw rows that cannot be read in root/quarantine instead of nulling (CSV) or failing (JSON lines)
    quarantine: bool = False
    # keep the 360 and the aggregates' parts in so many buckets of orders, so that an increment rewrites only some
    gold_buckets: int | None = None

    def path(self, layer: str, table: str) -> str:
        root = self.raw_root if layer == "raw" and self.raw_root else self.root
        return f"{root.rstrip('/')}/{getattr(self, layer)}/{table}"


# Session options the library relies on. Time zone is pinned so timestamp
# arithmetic is reproducible; ANSI stays on (bad cells go through try_cast).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "caseloom",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def materialize(df):
    """Compute ``df`` once into the cluster's checkpoint folder and cut its lineage.

    For an intermediate result that several later steps read: they read the
    checkpoint files instead of recomputing it, and a lost executor does not
    send recomputation back to the raw inputs."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    A local session (one machine, as in tests) that names none gets a folder of its own; on a cluster a local folder
    would be another one on every machine, so there it is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="caseloom-ckpt-", dir=os.environ.get("CASELOOM_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files that nothing refers to any more, in whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
