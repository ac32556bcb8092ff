"""The batch pipeline: raw → silver → model tables → gold → brief.

Each stage reads the layer the previous stage wrote and writes its own, so a
stage's lineage starts at stored files: a lost executor recomputes from the
last written layer, and the 360 table is computed once, then both aggregates
read it (OPT-9). Only these functions touch storage.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caseloom.config import PipelineConfig, materialize
from caseloom.operators import brief, incremental, kpis, mart, mergeable, reports, similarity, standardize
from caseloom.operators.embed import embed
from caseloom.operators.enrich import DEFAULT_RULES, RuleSet, enrich
from caseloom.sinks.writers import export_csv, replace_partitions, write_bucketed_table, write_table, write_text
from caseloom.sources.catalog import create_database, register_tables
from caseloom.sources.raw import read_raw_csv, read_raw_json, read_table, read_with_quarantine

CSV_TABLES = ["orders", "shipments", "returns", "products"]
ORDER_KEYED = ["orders", "shipments", "returns"]


def _silver_name(cfg: PipelineConfig, table: str) -> str:
    return f"`{cfg.database}`.`silver_{table}`"


def _read_silver(spark: SparkSession, cfg: PipelineConfig, table: str):
    if cfg.order_buckets and table in ORDER_KEYED:
        return spark.table(_silver_name(cfg, table))
    return read_table(spark, cfg.path("silver", table))


def _read_raw(spark: SparkSession, cfg: PipelineConfig, table: str, counts: dict[str, int]):
    """A raw table; with ``cfg.quarantine`` its unreadable rows go to root/quarantine and are counted."""
    path = cfg.path("raw", table)
    if cfg.quarantine:
        good, bad = read_with_quarantine(spark, path, table)
        counts[f"{table}_quarantined"] = write_table(bad, f"{cfg.root.rstrip('/')}/quarantine/{table}")
        return good
    return read_raw_json(spark, path) if table == "support_tickets" else read_raw_csv(spark, path, table)


def run_silver(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    """OUT-1..5: typed silver tables as Parquet, and how many filled cells of each could not be read as their type."""
    counts = {}
    for t in CSV_TABLES:
        raw = _read_raw(spark, cfg, t, counts)
        fn = standardize.STANDARDIZERS[t]
        nulled = Observation(f"nulled:{t}")
        raw = raw.observe(nulled, standardize.bad_cells(raw, fn(raw)).alias("cells"))
        df = fn(raw, cfg.delay_hours_threshold) if t == "shipments" else fn(raw)
        if cfg.order_buckets and t in ORDER_KEYED:
            create_database(spark, cfg)
            counts[t] = write_bucketed_table(df, _silver_name(cfg, t), cfg.path("silver", t), "order_id",
                                             cfg.order_buckets)
        else:
            counts[t] = write_table(df, cfg.path("silver", t))
        counts[f"{t}_bad_cells"] = int(nulled.get["cells"])
    tickets = standardize.standardize_tickets(_read_raw(spark, cfg, "support_tickets", counts))
    counts["support_tickets"] = write_table(tickets, cfg.path("silver", "support_tickets"))
    return counts


def run_tickets(spark: SparkSession, cfg: PipelineConfig, reply_fn: Callable | None = None,
                rules: RuleSet = DEFAULT_RULES, vector_fn=None, strict: bool = False) -> dict[str, int]:
    """OUT-6..8: enrichment, embeddings, top-N similar tickets. ``strict``: a bad reply fails the job."""
    tickets = read_table(spark, cfg.path("silver", "support_tickets"))
    counts = {"ticket_enrichment": write_table(enrich(tickets, reply_fn=reply_fn, rules=rules, strict=strict),
                                               cfg.path("model", "ticket_enrichment"))}
    enrichment = read_table(spark, cfg.path("model", "ticket_enrichment"))
    counts["ticket_embeddings"] = write_table(embed(enrichment, cfg.embedding_dim, vector_fn),
                                              cfg.path("model", "ticket_embeddings"))
    embeddings = read_table(spark, cfg.path("model", "ticket_embeddings"))
    pairs = similarity.top_matches(embeddings, enrichment, top_n=cfg.top_n,
                                   block_rows=cfg.similarity_block_rows,
                                   n_rows=counts["ticket_embeddings"])
    counts["ticket_similarity"] = write_table(pairs, cfg.path("model", "ticket_similarity"))
    return counts


def run_gold(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    """OUT-9..11: the 360 table once, then both aggregates from the stored copy."""
    m = mart.order_support_360(
        _read_silver(spark, cfg, "orders"),
        _read_silver(spark, cfg, "shipments"),
        _read_silver(spark, cfg, "returns"),
        read_table(spark, cfg.path("model", "ticket_enrichment")),
        read_table(spark, cfg.path("model", "ticket_similarity")),
        threshold=cfg.delay_hours_threshold, hot_key_rows=cfg.hot_key_rows,
    )
    if cfg.gold_buckets:
        m = m.withColumn(mergeable.BUCKET, mergeable.order_bucket(cfg.gold_buckets)).repartition(mergeable.BUCKET, F.xxhash64("ticket_id"))
    counts = {"order_support_360": write_table(m, cfg.path("gold", "order_support_360"),
                                               partition_by=[mergeable.BUCKET] if cfg.gold_buckets else None)}
    stored = read_table(spark, cfg.path("gold", "order_support_360"))
    if cfg.gold_buckets:
        for name, parts in _parts(stored).items():
            write_table(parts, cfg.path("gold", name), partition_by=[mergeable.BUCKET])
        counts.update(_merge_parts(spark, cfg))
    else:
        counts["issue_kpis"] = write_table(kpis.issue_kpis(stored), cfg.path("gold", "issue_kpis"))
        counts["city_issue_hotspots"] = write_table(kpis.city_issue_hotspots(stored),
                                                    cfg.path("gold", "city_issue_hotspots"))
    lost = mart.lost_tickets(_read_silver(spark, cfg, "orders"),
                             read_table(spark, cfg.path("model", "ticket_enrichment"))).first()
    counts["tickets_without_order"] = lost["lost"]
    return counts


def _parts(m: DataFrame) -> dict[str, DataFrame]:
    """The aggregates' parts per bucket of orders."""
    return {"issue_parts": mergeable.bucket_parts(m), "issue_order_parts": mergeable.category_orders(m)}


def _merge_parts(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    parts, orders = (read_table(spark, cfg.path("gold", n)) for n in ("issue_parts", "issue_order_parts"))
    return {"issue_kpis": write_table(mergeable.issue_kpis(parts, orders), cfg.path("gold", "issue_kpis")),
            "city_issue_hotspots": write_table(mergeable.city_issue_hotspots(parts), cfg.path("gold", "city_issue_hotspots"))}


def run_gold_increment(spark: SparkSession, cfg: PipelineConfig, changed: DataFrame) -> dict[str, int]:
    """OUT-9..11 after new rows: only buckets with an order of ``changed`` (order_id), or with a ticket whose best match
    is another now, are built and written. The gold layer must have been written with ``cfg.gold_buckets``."""
    path = cfg.path("gold", "order_support_360")
    stored, n = read_table(spark, path), cfg.gold_buckets
    enrichment, sim = (read_table(spark, cfg.path("model", t)) for t in ("ticket_enrichment", "ticket_similarity"))
    changed = materialize(incremental.changed_orders(changed, incremental.changed_matches(stored, sim)))
    touched = incremental.touched_buckets(changed, n)
    rows = incremental.refreshed(stored, changed, touched, n, *[_read_silver(spark, cfg, t) for t in ORDER_KEYED], enrichment, sim,
                                 threshold=cfg.delay_hours_threshold, hot_key_rows=cfg.hot_key_rows)
    # computed before its folders are replaced, as it reads some of them
    rows = materialize(rows.repartition(mergeable.BUCKET, F.xxhash64("ticket_id")))
    counts = {"changed_orders": changed.count(), "buckets": len(touched), "order_support_360": replace_partitions(rows, path, mergeable.BUCKET, touched)}
    for name, parts in _parts(rows).items():
        replace_partitions(parts, cfg.path("gold", name), mergeable.BUCKET, touched)
    return counts | _merge_parts(spark, cfg)


def run_brief(spark: SparkSession, cfg: PipelineConfig, brief_fn: Callable | None = None,
              export_csv_copies: bool = False) -> dict[str, int]:
    """OUT-12 (and SNK-5..8): register the tables, query, write the brief."""
    register_tables(spark, cfg)
    db = cfg.database
    kpi_top = reports.run_report_sql(spark, "brief_kpi_top10", db, cfg.brief_limit)
    hot_top = reports.run_report_sql(spark, "brief_hotspot_top10", db, cfg.brief_limit)
    counts = {"daily_ops_brief": write_text(brief.daily_brief(kpi_top, hot_top, brief_fn),
                                            cfg.path("gold", "daily_ops_brief"), "brief")}
    if export_csv_copies:
        for name in ("issue_kpis", "city_issue_hotspots"):
            counts[f"{name}_csv"] = export_csv(spark.table(f"`{db}`.{name}"), cfg.path("gold", f"{name}_csv"),
                                               single_file=True)
    return counts


def run_all(spark: SparkSession, cfg: PipelineConfig, **kwargs) -> dict[str, int]:
    """All stages in order."""
    counts = {}
    counts.update(run_silver(spark, cfg))
    counts.update(run_tickets(spark, cfg, reply_fn=kwargs.get("reply_fn"),
                              rules=kwargs.get("rules", DEFAULT_RULES), vector_fn=kwargs.get("vector_fn"),
                              strict=kwargs.get("strict", False)))
    counts.update(run_gold(spark, cfg))
    counts.update(run_brief(spark, cfg, brief_fn=kwargs.get("brief_fn")))
    return counts
