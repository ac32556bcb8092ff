"""Whole runs that readers see at once (SNK-3).

A run writes all its layers under a folder of its own, ``root/runs/<run>``, and is published by one row appended to the
table ``root/_published``. Spark moves that row's file into place as the last act of the append, so a reader sees the
run before or the run after, never a layer of each; a run that fails publishes nothing and the one before stays. The
catalog's tables follow once the run is published. Earlier runs stay readable until their folders are removed.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.config import PipelineConfig
from caseloom.plans.jobs import run_all
from caseloom.sources.catalog import register_tables

_SCHEMA = "published_at bigint, run string, counts map<string,bigint>"


def _folder(cfg: PipelineConfig) -> str:
    return f"{cfg.root.rstrip('/')}/_published"


def runs(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """published_at, run, counts of every published run."""
    try:
        return spark.read.schema(_SCHEMA).parquet(_folder(cfg))
    except AnalysisException as e:  # nothing was published yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)


def of_run(cfg: PipelineConfig, run: str) -> PipelineConfig:
    """The config under which a run's layers are read."""
    return replace(cfg, root=f"{cfg.root.rstrip('/')}/runs/{run}", raw_root=cfg.raw_root or cfg.root)


def published(spark: SparkSession, cfg: PipelineConfig) -> PipelineConfig | None:
    """The config of the last published run; None if there is none. A reader keeps it for all it reads together."""
    last = runs(spark, cfg).orderBy(F.col("published_at").desc(), F.col("run").desc()).select("run").head(1)
    return of_run(cfg, last[0]["run"]) if last else None


def run_and_publish(spark: SparkSession, cfg: PipelineConfig, stages=run_all, **kwargs) -> dict[str, int]:
    """All stages into a new run's folder, then its publication; the stages' counts."""
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    mine = of_run(cfg, run)
    counts = stages(spark, replace(mine, database=f"{cfg.database}_{run.replace('-', '_')}"), **kwargs)
    row = spark.createDataFrame([(time.time_ns(), run, {k: int(v) for k, v in counts.items()})], _SCHEMA)
    row.coalesce(1).write.mode("append").parquet(_folder(cfg))
    register_tables(spark, mine)
    return counts
