"""Parsing a text model's JSON reply (FN-2, FN-3) with Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.schemas import ISSUE_CATEGORIES, REPLY_KEYS, SENTIMENTS, URGENCIES

MESSAGE_KEY, FOLLOWUP_KEY = "pii_redacted_message", "requires_human_followup"

# Unicode's White_Space characters. Spark's trim takes a set of characters and looks at the edges only.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
FENCE, NAMED_FENCE = "```", "```json"


def _strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE_SPACE))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def strip_fences(raw: Column | str) -> Column:
    """FN-2: trim; drop a leading ```json (any case) or ```; drop a trailing ```."""
    col = F.col(raw) if isinstance(raw, str) else raw

    def without_head(text: Column, head: str) -> Column:
        return F.when(F.lower(F.substring(text, 1, len(head))) == head, _strip(F.substring(text, len(head) + 1, 1 << 30))).otherwise(text)

    def without_tail(text: Column) -> Column:
        return F.when(F.endswith(text, F.lit(FENCE)), _strip(F.substring(text, F.lit(1), F.length(text) - len(FENCE)))).otherwise(text)

    unfenced = _let(_strip(col), lambda a: _let(without_head(a, NAMED_FENCE), lambda b: _let(without_head(b, FENCE), without_tail)))
    return F.when(F.contains(col, F.lit(FENCE)), unfenced).otherwise(_strip(col))


def _to_bool(col: Column) -> Column:
    low = F.lower(_strip(col))
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


def reply_fields(raw: Column) -> Column:
    """A struct of the eight reply fields, ``error`` (null where all is well) and ``enum_ok``.

    One expression in which every step has a name of its own (``_let``): where Spark moves a condition on a field, or a
    projection, it copies this expression once and not each step into the next.
    """
    # The text is read as the only element of a JSON array: prose or a second object after the first makes the array
    # invalid or longer. Only where a field came out null does a map say whether its key is there; most are read once.
    strict = {"allowSingleQuotes": "false"}
    fields = T.StructType([T.StructField(k, T.StringType()) for k in REPLY_KEYS])

    def result(reply: Column, keys: Column) -> Column:
        missing = F.concat_ws(",", *[F.when(~F.map_contains_key(keys, k), F.lit(k)) for k in REPLY_KEYS])  # no map: none
        error = _let(missing, lambda m: (
            F.when(raw.isNull(), F.lit("no reply"))
            .when(reply.isNull(), F.lit("unparseable reply"))
            .when(m != "", F.concat(F.lit("missing keys: "), m))
            # every other key may be null, but the message is what gets masked and kept
            .when(reply.getField(MESSAGE_KEY).isNull(), F.lit(f"null {MESSAGE_KEY}"))))
        followup = _to_bool(reply.getField(FOLLOWUP_KEY))
        allowed = [reply.getField(k).isin(v) for k, v in (("issue_category", ISSUE_CATEGORIES), ("sentiment", SENTIMENTS), ("urgency", URGENCIES))]
        enum_ok = F.coalesce(reduce(Column.__and__, allowed, followup.isNotNull()), F.lit(False))
        return F.struct(*[(followup if k == FOLLOWUP_KEY else reply.getField(k)).alias(k) for k in REPLY_KEYS],
                        error.alias("error"), enum_ok.alias("enum_ok"))

    def read(wrapped: Column) -> Column:
        def with_keys(reply: Column) -> Column:
            some_null = reduce(Column.__or__, [reply.getField(k).isNull() for k in REPLY_KEYS])
            found = F.get(F.from_json(wrapped, T.ArrayType(T.MapType(T.StringType(), T.StringType())), strict), F.lit(0))
            return _let(F.when(reply.isNotNull() & some_null, found), lambda keys: result(reply, keys))

        return _let(F.from_json(wrapped, T.ArrayType(fields), strict),
                    lambda found: _let(F.when(F.size(found) == 1, F.get(found, F.lit(0))), with_keys))

    return _let(F.concat(F.lit("["), strip_fences(raw), F.lit("]")), read)


def parse_reply(df: DataFrame, reply_col: str = "reply", prefix: str = "") -> DataFrame:
    """FN-2/FN-3: add the eight reply fields, ``reply_error`` and ``enum_ok``.

    A reply that is not a JSON object, or lacks a required key, is not dropped
    and does not abort the batch: ``reply_error`` says why (SEM-7). Enum values
    are checked, never rewritten (SEM-8).
    """
    parsed = df.withColumn("_parsed", reply_fields(F.col(reply_col)))
    field = F.col("_parsed").getField
    return parsed.withColumns({"reply_error": field("error"), **{prefix + k: field(k) for k in REPLY_KEYS},
                               "enum_ok": field("enum_ok")}).drop("_parsed")
