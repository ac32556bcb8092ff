"""Metric block and daily brief (OUT-12: FN-6, AGG-10, FN-7, UDF-3).

Inputs are the two top-N report frames (at most ``limit`` rows each, so the one
group that assembles the text is bounded by construction). The text is built by
one aggregate over the union of both frames: no driver loop, no cross join.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import HOTSPOT_HEADER, KPI_HEADER, brief_instruction, brief_prompt, hotspot_line, kpi_line, \
    result_text


def _desc_keys(col: str) -> list[Column]:
    # DESC NULLS LAST expressed as two ascending keys
    return [F.col(col).isNull(), -F.col(col).cast("double")]


def _asc_keys(col: Column) -> list[Column]:
    return [col.isNull(), F.coalesce(col, F.lit(""))]


def _entry(section: int, keys: list[Column], line: Column, fields: dict[str, Column]) -> Column:
    names = ["section", "k1", "k2", "k3", "k4", "k5", "k6", "k7", "k8"]
    cols = [F.lit(section)] + keys
    parts = [c.alias(n) for c, n in zip(cols, names)]
    parts.append(line.alias("line"))
    for name in ["category", "tickets", "orders", "delay", "refund", "city"]:
        parts.append(fields.get(name, F.lit("")).alias(name))
    return F.struct(*parts)


def metric_entries(kpi_top: DataFrame, hotspot_top: DataFrame) -> DataFrame:
    """One row, column ``entries``: both sections' rows in report order."""
    kpis = kpi_top.select(_entry(
        1,
        _desc_keys("ticket_count") + _desc_keys("average_delay_hours")
        + _asc_keys(F.col("issue_category")) + _asc_keys(F.lit(None).cast("string")),
        kpi_line(),
        {"category": result_text("issue_category"), "tickets": result_text("ticket_count"),
         "orders": result_text("impacted_orders"), "delay": result_text("average_delay_hours"),
         "refund": result_text("average_refund_amount")},
    ).alias("e"))
    hotspots = hotspot_top.select(_entry(
        2,
        _desc_keys("ticket_count") + _desc_keys("average_delay_hours")
        + _asc_keys(F.col("city")) + _asc_keys(F.col("issue_category")),
        hotspot_line(),
        {"category": result_text("issue_category"), "tickets": result_text("ticket_count"),
         "delay": result_text("average_delay_hours"), "city": result_text("city")},
    ).alias("e"))
    return kpis.unionByName(hotspots).agg(F.sort_array(F.collect_list("e")).alias("entries"))


def _section(entries: Column, n: int) -> Column:
    return F.filter(entries, lambda e: e["section"] == F.lit(n))


def block_text(entries: Column) -> Column:
    """AGG-10: header, KPI lines, blank line, header, hotspot lines."""
    lines = F.concat(
        F.array(F.lit(KPI_HEADER)),
        F.transform(_section(entries, 1), lambda e: e["line"]),
        F.array(F.lit(""), F.lit(HOTSPOT_HEADER)),
        F.transform(_section(entries, 2), lambda e: e["line"]),
    )
    return F.array_join(lines, "\n")


def metrics_block(kpi_top: DataFrame, hotspot_top: DataFrame) -> DataFrame:
    """FN-6 + AGG-10: one row, column ``metrics_block``."""
    return metric_entries(kpi_top, hotspot_top).select(block_text(F.col("entries")).alias("metrics_block"))


def brief_prompt_text(kpi_top: DataFrame, hotspot_top: DataFrame) -> DataFrame:
    """FN-7: one row, column ``prompt``: what a text model would be asked."""
    return metric_entries(kpi_top, hotspot_top).select(brief_prompt(block_text(F.col("entries"))).alias("prompt"))


def _brief_text(entries: Column) -> Column:
    """UDF-3 default: headline, issue-pattern paragraph, action paragraph, block.

    Deterministic template; the highest-risk category is the first KPI row."""
    kpis = _section(entries, 1)
    hots = _section(entries, 2)
    top = F.element_at(kpis, 1)
    second = F.element_at(kpis, 2)
    hot = F.element_at(hots, 1)
    has_kpi = F.size(kpis) > 0
    has_hot = F.size(hots) > 0
    headline = F.when(
        has_kpi,
        F.concat(F.lit("# Daily operations brief: "), top["category"], F.lit(" is the highest-risk issue category")),
    ).otherwise(F.lit("# Daily operations brief: no support tickets in the gold tables"))
    hotspot_sentence = F.when(
        has_hot,
        F.concat(F.lit(" The largest hotspot is "), hot["city"], F.lit(" / "), hot["category"],
                 F.lit(" with "), hot["tickets"], F.lit(" tickets (average delay "), hot["delay"],
                 F.lit(" hours).")),
    ).otherwise(F.lit(""))
    patterns = F.when(
        has_kpi,
        F.concat(
            top["category"], F.lit(" leads with "), top["tickets"], F.lit(" tickets across "),
            top["orders"], F.lit(" impacted orders, an average delay of "), top["delay"],
            F.lit(" hours and an average refund of "), top["refund"], F.lit("."), hotspot_sentence,
        ),
    ).otherwise(F.lit("No ticket metrics are available for today."))
    follow = F.when(
        F.size(kpis) > 1,
        F.concat(F.lit(" Then review "), second["category"], F.lit(" ("), second["tickets"], F.lit(" tickets).")),
    ).otherwise(F.lit(""))
    where = F.when(has_hot, F.concat(F.lit(", starting in "), hot["city"])).otherwise(F.lit(""))
    actions = F.when(
        has_kpi,
        F.concat(F.lit("Prioritize the "), top["category"], F.lit(" backlog today"), where, F.lit("."), follow),
    ).otherwise(F.lit("No action is needed today."))
    return F.concat_ws("\n\n", headline, patterns, actions,
                       F.concat(F.lit("## Metrics\n\n"), block_text(entries)))


PATTERN_HEADER = "## Patterns"


def _with_patterns(entries: DataFrame, lines: DataFrame | None) -> DataFrame:
    """The entries with ``found``, the pattern lines as a list; both are one row."""
    if lines is None:
        return entries.withColumn("found", F.array().cast("array<string>"))
    found = lines.agg(F.sort_array(F.collect_list(F.struct("rank", "line"))).alias("f")).select(F.transform("f", lambda x: x["line"]).alias("found"))
    rows = entries.withColumn("found", F.lit(None).cast("array<string>")).unionByName(
        found.withColumn("entries", F.lit(None).cast(entries.schema["entries"].dataType)))
    return rows.agg(F.max_by("entries", F.col("entries").isNotNull()).alias("entries"), F.max_by("found", F.col("found").isNotNull()).alias("found"))


def daily_brief(kpi_top: DataFrame, hotspot_top: DataFrame, brief_fn: Callable | None = None,
                pattern_lines: DataFrame | None = None) -> DataFrame:
    """OUT-12: one row, column ``brief`` (Markdown).

    ``pattern_lines`` (``patterns.pattern_lines``): what stands out, as a list after the paragraphs, or for the model.
    ``brief_fn``: optional model call ``pd.Series[prompt] -> pd.Series[text]``
    applied to the FN-7 prompt instead of the template."""
    both = _with_patterns(metric_entries(kpi_top, hotspot_top), pattern_lines)
    listed = F.when(F.size("found") > 0, F.concat(F.lit(PATTERN_HEADER + "\n\n"), F.array_join(F.transform("found", lambda x: F.concat(F.lit("- "), x)), "\n")))
    if brief_fn is None:
        return both.select(F.concat_ws("\n\n", _brief_text(F.col("entries")), listed).alias("brief"))
    from caseloom.operators.enrich import model_reply_udf

    metrics = F.concat_ws("\n\n", block_text(F.col("entries")), listed)
    prompt = F.concat(F.lit(brief_instruction() + "\n\n"), brief_prompt(metrics))
    return both.select(model_reply_udf(brief_fn)(prompt).alias("brief"))
