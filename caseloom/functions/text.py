"""Text templates as Column expressions (FN-4..FN-7, SRC-6 text rendering)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.schemas import ISSUE_CATEGORIES, REPLY_KEYS, SENTIMENTS, URGENCIES

# A missing value renders as the word None inside prompts and embedding text,
# which is what a Python f-string prints for it; in metric lines (query results
# fetched as text) it renders as the empty string.
NONE_TEXT = "None"

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's text formats).
# ---------------------------------------------------------------------------
TICKET_PROMPT_HEAD = "Enrich this support ticket for downstream analytics."
TICKET_PROMPT_FIELDS = [
    ("Ticket ID: ", "ticket_id"),
    ("Order ID: ", "order_id"),
    ("Channel: ", "channel"),
    ("Customer message: ", "customer_message"),
    ("Agent notes: ", "agent_notes"),
]
EMBEDDING_TEXT_PARTS = ("Issue category: ", ". Summary: ", ". Customer message: ")
KPI_HEADER = "Top issue KPI rows:"
HOTSPOT_HEADER = "Top city hotspot rows:"
BRIEF_PROMPT_HEAD = """Write a daily operations brief using the curated metrics below.

Requirements:
- Start with a one-line headline
- Then write one paragraph on major issue patterns
- Then write one paragraph on actions to prioritize today
- Mention the highest-risk issue category explicitly

Metrics:
"""

# (the guard before the trailing run keeps this linear on long inner runs of
# white space: only a run's first character is tried as a start)
_EDGE_SPACE = r"(?U)^\s+|(?<!\s)\s+$"


def ticket_instruction() -> str:
    """What a model must know to answer in the form ``parse_reply`` reads: keys, allowed values, rules."""
    return "\n".join([
        "Answer with one JSON object and nothing else.",
        "It must hold these keys: " + ", ".join(REPLY_KEYS) + ".",
        "issue_category is one of: " + ", ".join(ISSUE_CATEGORIES) + ".",
        "sentiment is one of: " + ", ".join(SENTIMENTS) + ". urgency is one of: " + ", ".join(URGENCIES) + ".",
        "requires_human_followup is true or false.",
        "pii_redacted_message is the customer's message with phone numbers and e-mail addresses masked.",
        "Keep the other fields to one short sentence each and invent nothing.",
    ])


def brief_instruction() -> str:
    """The tone a model writes the brief in."""
    return "You write for operations managers: plain, factual, short. Use only the numbers given."


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_text(col: Column | str) -> Column:
    """Render a value the way a Python f-string would (null → ``None``)."""
    return F.coalesce(_c(col).cast("string"), F.lit(NONE_TEXT))


def result_text(col: Column | str) -> Column:
    """Render a query-result cell as text; null → empty string (SEM-25)."""
    return F.coalesce(_c(col).cast("string"), F.lit(""))


def ticket_prompt(ticket_id="ticket_id", order_id="order_id", channel="channel",
                  customer_message="customer_message", agent_notes="agent_notes") -> Column:
    """FN-4: the per-ticket user prompt, outer white space stripped."""
    cols = dict(ticket_id=ticket_id, order_id=order_id, channel=channel,
                customer_message=customer_message, agent_notes=agent_notes)
    parts = [F.lit(TICKET_PROMPT_HEAD + "\n")]
    for label, key in TICKET_PROMPT_FIELDS:
        parts += [F.lit("\n" + label), py_text(cols[key])]
    return F.regexp_replace(F.concat(*parts), _EDGE_SPACE, "")


def embedding_text(issue_category="issue_category", customer_summary="customer_summary",
                   message="pii_redacted_message") -> Column:
    """FN-5: composite text handed to the embedding model."""
    a, b, c = EMBEDDING_TEXT_PARTS
    return F.concat(F.lit(a), py_text(issue_category), F.lit(b), py_text(customer_summary),
                    F.lit(c), py_text(message))


def kpi_line() -> Column:
    """FN-6: one KPI line of the metric block."""
    return F.concat(
        F.lit("- "), result_text("issue_category"),
        F.lit(": tickets="), result_text("ticket_count"),
        F.lit(", impacted_orders="), result_text("impacted_orders"),
        F.lit(", avg_delay_hours="), result_text("average_delay_hours"),
        F.lit(", avg_refund_amount="), result_text("average_refund_amount"),
    )


def hotspot_line() -> Column:
    """FN-6: one hotspot line of the metric block."""
    return F.concat(
        F.lit("- "), result_text("city"), F.lit(" / "), result_text("issue_category"),
        F.lit(": tickets="), result_text("ticket_count"),
        F.lit(", avg_delay_hours="), result_text("average_delay_hours"),
    )


def brief_prompt(metrics_block: Column | str = "metrics_block") -> Column:
    """FN-7: the user prompt of the brief, outer white space stripped."""
    return F.regexp_replace(F.concat(F.lit(BRIEF_PROMPT_HEAD), py_text(metrics_block)), _EDGE_SPACE, "")
