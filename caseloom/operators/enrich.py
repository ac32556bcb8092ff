"""Ticket enrichment (OUT-6): prompt → reply → parsed fields → masked message.

Four ways to produce the reply, all distributed:

* ``reply=<column>``: the reply text is already a column (a model's stored
  output, or a simulated one); it is parsed with Column expressions.
* ``reply_fn=<callable>``: a caller-supplied model call, ``pandas.Series`` of
  prompts (the reply format first, then the ticket) → ``pandas.Series`` of reply texts, run as an Arrow-batched pandas UDF
  on the executors (one call per batch, not per row on the driver).
* ``model=<ReplyModel>``: a classifier trained on stored replies
  (``operators.learn``), scored in Arrow batches.
* none of them: a rule classifier made of ``rlike`` Column expressions (default,
  since no model service is reachable). The rules are an argument.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.pii import redact
from caseloom.functions.replies import parse_reply
from caseloom.functions.text import ticket_instruction, ticket_prompt
from caseloom.operators.learn import ReplyModel, learned_reply
from caseloom.schemas import ENRICHMENT_COLUMNS, ISSUE_CATEGORIES, SENTIMENTS, URGENCIES


def word(w: str) -> str:
    """A whole word, with explicit Unicode word classes (portable across regex engines)."""
    return rf"(^|[^\p{{L}}\p{{N}}_]){w}([^\p{{L}}\p{{N}}_]|$)"


@dataclass(frozen=True)
class RuleSet:
    """Ordered (value, regex) rules; the first match wins, else the default.

    Words are bounded by non-letters that every engine knows (see ``word``). What a customer declines ("instead of a
    refund") must not count as asked for, so the rules that name the fault come before those that name the remedy.
    """

    categories: list = field(default_factory=lambda: [
        ("RETURN_PICKUP_DELAY", word("(pick ?-?ups?|reverse logistics|collections? (windows?|slots?|agents?))")),
        ("WRONG_ITEM_SENT", word("(wrong|mismatch(ed)?|mixed up|(completely )?different (items?|products?|sizes?|colou?rs?)|not what i ordered)")),
        ("PAYMENT_ISSUE", word("(payments?|charged|charges|double charge|billing|invoices?|debit(ed)?|cards?|upi)")),
        ("REPLACEMENT_REQUEST", word("(replacements?|replace(d)?|exchanges?) (instead|rather than|and no(t a)? refund)")
         + "|" + word("(specifically|only) (asked for|wants?) (a )?(replacement|exchange)")),
        ("DAMAGED_ITEM", word("(damag(e|es|ed|ing)|broken|broke|crack(s|ed)?|dent(s|ed)?|torn|shatter(ed)?|smashed)")),
        ("REPLACEMENT_REQUEST", word("(replacements?|replace(d)?|exchanges?|defective|faulty|not working)")),
        ("REFUND_DELAY", word("(refunds?|refunded|settlements?|money back|reimburs(e|ed|ement))")),
        ("DELIVERY_EXCEPTION", word("(delivery exception|proof of delivery|never (received|arrived)|nothing (was )?(actually )?received|marked (as )?delivered"
                                    "|lost|missing|return(ed)? to sender|undelivered|undeliverable|(wrong|incomplete) address)")),
        ("DELIVERY_DELAY", word("(delay(s|ed)?|late|eta|transit|overdue|not (yet )?(arrived|delivered)|still waiting|where is my)")),
    ])
    default_category: str = "GENERAL_QUERY"
    sentiments: list = field(default_factory=lambda: [
        ("NEGATIVE", word("(angry|frustrat(ed|ing)|terrible|worst|unacceptable|disappoint(ed|ing)|dissatisfied|upset|annoy(ed|ing))") + "|!!"),
        ("POSITIVE", word("(thanks?|thank you|great|appreciate(d)?|happy|glad)")),
    ])
    default_sentiment: str = "NEUTRAL"
    urgencies: list = field(default_factory=lambda: [
        ("HIGH", word("(urgent(ly)?|asap|immediate(ly)?|escalat(e|ed|ion)|legal|chargeback|today)")),
    ])
    default_urgency: str = "MEDIUM"
    low_urgency_categories: tuple = ("GENERAL_QUERY",)
    root_causes: dict = field(default_factory=lambda: {
        "DELIVERY_DELAY": "Carrier transit delay",
        "DAMAGED_ITEM": "Packaging or handling damage",
        "WRONG_ITEM_SENT": "Warehouse picking error",
        "DELIVERY_EXCEPTION": "Carrier delivery exception",
        "REFUND_DELAY": "Refund processing backlog",
        "PAYMENT_ISSUE": "Payment capture or reconciliation error",
        "RETURN_PICKUP_DELAY": "Reverse pickup not scheduled",
        "REPLACEMENT_REQUEST": "A like-for-like exchange was asked for",
        "GENERAL_QUERY": "General information request",
    })
    actions: dict = field(default_factory=lambda: {
        "DELIVERY_DELAY": "Escalate with the carrier and share a revised delivery date",
        "DAMAGED_ITEM": "Arrange a replacement and file a carrier damage claim",
        "WRONG_ITEM_SENT": "Ship the correct item and schedule pickup of the wrong one",
        "DELIVERY_EXCEPTION": "Confirm the address with the customer and re-attempt delivery",
        "REFUND_DELAY": "Check refund status with finance and confirm the payout date",
        "PAYMENT_ISSUE": "Reconcile the payment and reverse any duplicate charge",
        "RETURN_PICKUP_DELAY": "Book the reverse pickup and confirm the slot",
        "REPLACEMENT_REQUEST": "Approve the replacement and ship it",
        "GENERAL_QUERY": "Answer the query and close the ticket",
    })


DEFAULT_RULES = RuleSet()


def _first_match(text: Column, rules, default: str) -> Column:
    out = F.lit(default)
    for value, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(value)).otherwise(out)
    return out


def _lookup(key: Column, table: dict) -> Column:
    out = F.lit(None).cast("string")
    for k, v in reversed(list(table.items())):
        out = F.when(key == F.lit(k), F.lit(v)).otherwise(out)
    return out


def rule_reply(df: DataFrame, rules: RuleSet = DEFAULT_RULES,
               message: str = "customer_message", notes: str = "agent_notes") -> DataFrame:
    """UDF-1 (default): the eight reply fields from rules, as Column expressions.

    Patterns are matched against the lower-cased message and notes."""
    text = F.lower(F.concat_ws(" ", F.col(message), F.col(notes)))
    category = _first_match(text, rules.categories, rules.default_category)
    sentiment = _first_match(text, rules.sentiments, rules.default_sentiment)
    urgency_hit = _first_match(text, rules.urgencies, rules.default_urgency)
    out = df.withColumns({
        "_text": text,
        "issue_category": category,
        "sentiment": sentiment,
    })
    urgency = (
        F.when(urgency_hit != F.lit(rules.default_urgency), urgency_hit)
        .when(F.col("issue_category").isin(*rules.low_urgency_categories), F.lit("LOW"))
        .otherwise(F.lit(rules.default_urgency))
    )
    summary = F.concat(
        F.lit("Customer reports "), F.lower(F.regexp_replace(F.col("issue_category"), "_", " ")),
        F.lit(" on order "), F.coalesce(F.col("order_id"), F.lit("unknown")), F.lit("."),
    )
    return (
        out.withColumn("urgency", urgency.alias("urgency"))
        .withColumns({
            "requires_human_followup": (F.col("urgency") == "HIGH") | (F.col("sentiment") == "NEGATIVE"),
            "root_cause_hint": _lookup(F.col("issue_category"), rules.root_causes),
            "pii_redacted_message": F.col(message),
            "customer_summary": summary,
            "next_best_action": _lookup(F.col("issue_category"), rules.actions),
            "reply_error": F.lit(None).cast("string"),
            "enum_ok": F.col("issue_category").isin(ISSUE_CATEGORIES)
            & F.col("sentiment").isin(SENTIMENTS) & F.col("urgency").isin(URGENCIES),
        })
        .drop("_text")
    )


def model_reply_udf(reply_fn: Callable):
    """Wrap ``reply_fn(pd.Series[str]) -> pd.Series[str]`` as a pandas UDF.

    A model call may answer differently each time and costs money: marked nondeterministic, the optimizer neither
    repeats nor moves it."""

    @F.pandas_udf("string")
    def _call(prompts: pd.Series) -> pd.Series:
        return pd.Series(reply_fn(prompts), index=prompts.index).astype(object)

    return _call.asNondeterministic()


def enrich(tickets: DataFrame, reply: str | None = None, reply_fn: Callable | None = None,
           rules: RuleSet = DEFAULT_RULES, strict: bool = False, model: ReplyModel | None = None) -> DataFrame:
    """OUT-6 / PRJ-13: one enrichment row per ticket, never dropped.

    Output: the 14 enrichment columns, then ``reply_error`` (null when the reply
    was complete) and ``enum_ok``. ``strict=True`` fails the job on the first
    bad reply instead (the source behaviour).
    """
    if reply is not None or reply_fn is not None:
        staged = tickets
        if reply is None:
            asked = F.concat(F.lit(ticket_instruction() + "\n\n"), ticket_prompt())
            staged = tickets.withColumn("_model_reply", model_reply_udf(reply_fn)(asked))
            reply = "_model_reply"
        parsed = parse_reply(staged.withColumnRenamed(reply, "_reply_text"), "_reply_text")
    elif model is not None:
        parsed = learned_reply(tickets, model)
    else:
        parsed = rule_reply(tickets, rules)
    masked = parsed.withColumn("pii_redacted_message", redact(F.col("pii_redacted_message")))
    if strict:  # in a filter, which no projection or count can drop
        bad = F.raise_error(F.concat(F.lit("bad model reply for ticket "), F.coalesce(F.col("ticket_id"), F.lit("?")),
                                     F.lit(": "), F.col("reply_error")))
        masked = masked.filter(F.when(F.col("reply_error").isNotNull(), bad.cast("boolean")).otherwise(True))
    return masked.select(*ENRICHMENT_COLUMNS, "reply_error", "enum_ok")
