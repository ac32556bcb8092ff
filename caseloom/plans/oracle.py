"""DuckDB SQL for every registered query: an independent engine computing the
same answers from the same Parquet tables.

Dialect notes, each a place where the two engines differ by default:

* ``SROUND(x, d)``: Spark's ``round`` works on the decimal text of a double
  (1.005 → 1.01); DuckDB rounds the binary value. The oracle rounds the
  decimal text too.
* Regexes use explicit Unicode classes (``\\p{L}``, ``\\p{Nd}``) because RE2's
  ``\\w``/``\\d``/``\\b`` are ASCII; RE2 has no look-around, so the phone pattern
  captures its neighbours and runs twice (adjacent runs share a neighbour).
* Ties and limits use the same total orders as the Spark side, NULLS LAST.
"""

from __future__ import annotations

from caseloom.functions.pii import EMAIL_TOKEN, PHONE_TOKEN
from caseloom.functions.text import (BRIEF_PROMPT_HEAD, EMBEDDING_TEXT_PARTS, HOTSPOT_HEADER, KPI_HEADER,
                                     TICKET_PROMPT_FIELDS, TICKET_PROMPT_HEAD)
from caseloom.operators.enrich import DEFAULT_RULES, RuleSet
from caseloom.operators.latent import SLOTS as LATENT_SLOTS
from caseloom.operators.learn import HEADS, SCALE, SLOTS
from caseloom.schemas import ISSUE_CATEGORIES
from caseloom.sources.analog import CORPUS_RULES


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sround(x: str, d: int) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38, 12)), {d}) AS DOUBLE)"


def _decimal_mean(x: str) -> str:
    """Mean of the values as decimals, rounded to two places."""
    return sround(f"CAST(sum(CAST({x} AS DECIMAL(28, 9))) AS DOUBLE) / count({x})", 2)


_W = r"\p{L}\p{N}_"
_PHONE = rf"(^|[^{_W}])\p{{Nd}}{{10}}($|[^{_W}])"
_EMAIL = rf"[{_W}.-]+@[{_W}.-]+\.[{_W}]+"


def redact(x: str) -> str:
    once = f"regexp_replace(({x}), {q(_PHONE)}, {q(chr(92) + '1' + PHONE_TOKEN + chr(92) + '2')}, 'g')"
    twice = f"regexp_replace({once}, {q(_PHONE)}, {q(chr(92) + '1' + PHONE_TOKEN + chr(92) + '2')}, 'g')"
    return f"regexp_replace({twice}, {q(_EMAIL)}, {q(EMAIL_TOKEN)}, 'g')"


_SPACE = r"[\s\p{Z}\x{0B}\x{85}]"


def strip(x: str) -> str:
    return f"regexp_replace(({x}), {q('^' + _SPACE + '+|' + _SPACE + '+$')}, '', 'g')"


def txt(x: str) -> str:
    """Result cell as text, null → ''."""
    return f"coalesce(CAST(({x}) AS VARCHAR), '')"


def pytxt(x: str) -> str:
    """Python f-string rendering, null → 'None'."""
    return f"coalesce(CAST(({x}) AS VARCHAR), 'None')"


def _category_case(k: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {q(c)}" for i, c in enumerate(ISSUE_CATEGORIES))
    return f"CASE ({k}) % {len(ISSUE_CATEGORIES)} {whens} END"


def _first_match(text: str, rules, default: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({text}, {q(p)}) THEN {q(v)}" for v, p in rules)
    return f"CASE {whens} ELSE {q(default)} END"


def _lookup(key: str, table: dict) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items())
    return f"CASE {key} {whens} END"


def _hex(h: str, start: int, n: int) -> str:
    digits = [f"(instr('0123456789abcdef', substr({h}, {start + i}, 1)) - 1) * {16 ** (n - 1 - i)}"
              for i in range(n)]
    return "(" + " + ".join(digits) + ")"


def rule_enrichment_select(src: str, rules: RuleSet) -> str:
    t = "lower(concat_ws(' ', customer_message, agent_notes))"
    cat = _first_match(t, rules.categories, rules.default_category)
    sent = _first_match(t, rules.sentiments, rules.default_sentiment)
    hit = _first_match(t, rules.urgencies, rules.default_urgency)
    low = ", ".join(q(c) for c in rules.low_urgency_categories)
    return f"""
SELECT ticket_id, order_id, customer_id, created_at, channel, issue_category, sentiment, urgency,
       (urgency = 'HIGH' OR sentiment = 'NEGATIVE') AS requires_human_followup,
       {_lookup('issue_category', rules.root_causes)} AS root_cause_hint,
       {redact('customer_message')} AS pii_redacted_message,
       'Customer reports ' || lower(replace(issue_category, '_', ' ')) || ' on order '
         || coalesce(order_id, 'unknown') || '.' AS customer_summary,
       {_lookup('issue_category', rules.actions)} AS next_best_action,
       agent_notes, CAST(NULL AS VARCHAR) AS reply_error, true AS enum_ok
FROM (SELECT *, CASE WHEN hit <> {q(rules.default_urgency)} THEN hit
                     WHEN issue_category IN ({low}) THEN 'LOW' ELSE {q(rules.default_urgency)} END AS urgency
      FROM (SELECT *, {cat} AS issue_category, {sent} AS sentiment, {hit} AS hit FROM {src}) a) b"""


def _similarity_select(src: str, top_n: int = 3) -> str:
    """Exact top-N cosine over all ordered pairs (oracle only; small tables)."""
    return f"""
SELECT ticket_id, matched_ticket_id, ticket_issue_category, matched_issue_category,
       CAST(rn AS INTEGER) AS similarity_rank, {sround('score', 6)} AS similarity_score,
       ticket_summary, matched_ticket_summary, recommended_action_pattern
FROM (SELECT *, row_number() OVER (PARTITION BY ticket_id
                 ORDER BY CASE WHEN isnan(score) THEN NULL ELSE round(score, 12) END DESC NULLS LAST,
                          matched_ticket_id) AS rn
      FROM (SELECT a.ticket_id, b.ticket_id AS matched_ticket_id, a.issue_category AS ticket_issue_category,
                   b.issue_category AS matched_issue_category, a.customer_summary AS ticket_summary,
                   b.customer_summary AS matched_ticket_summary, b.next_best_action AS recommended_action_pattern,
                   CASE WHEN a.nrm = 0 OR b.nrm = 0 THEN 0.0
                        ELSE list_dot_product(a.embedding, b.embedding) / (a.nrm * b.nrm) END AS score
            FROM (SELECT *, sqrt(list_dot_product(embedding, embedding)) AS nrm FROM {src}) a
            JOIN (SELECT *, sqrt(list_dot_product(embedding, embedding)) AS nrm FROM {src}) b
              ON a.ticket_id <> b.ticket_id) pairs) ranked
WHERE rn <= {top_n}"""


_MSG = """CASE WHEN k % 10 = 3 THEN 'Please call me on 98' || lpad(CAST(event_id % 100000000 AS VARCHAR), 8, '0')
                              || ' about order ' || CAST(event_id AS VARCHAR) || '.'
            WHEN k % 10 = 6 THEN 'Write to buyer.' || CAST(user_id AS VARCHAR) || '@shop-mail.com about order '
                              || CAST(event_id AS VARCHAR) || '.'
            ELSE upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || ' problem with order '
                 || CAST(event_id AS VARCHAR) || '.' END"""

_EMB_TEXT = (f"{q(EMBEDDING_TEXT_PARTS[0])} || {pytxt('issue_category')} || {q(EMBEDDING_TEXT_PARTS[1])} || "
             f"{pytxt('customer_summary')} || {q(EMBEDDING_TEXT_PARTS[2])} || {pytxt('pii_redacted_message')}")

_PROMPT = strip(" || ".join(
    [q(TICKET_PROMPT_HEAD + "\n")]
    + [f"{q(chr(10) + label)} || {pytxt(col)}" for label, col in TICKET_PROMPT_FIELDS]))

_MART_COLS = """o.order_id, o.customer_id, o.customer_name, o.product_id, o.product_name, o.product_category,
       o.order_date, o.city, o.quantity, o.unit_price, o.order_amount, o.payment_status,
       s.shipment_id, s.carrier, s.dispatch_time, s.expected_delivery_time, s.delivery_time,
       coalesce(s.delay_hours, 0.0) AS delay_hours, s.shipment_status,
       r.return_id, r.reason_code, coalesce(r.refund_amount, 0.0) AS refund_amount, r.return_status,
       te.ticket_id, te.issue_category, te.sentiment, te.urgency, te.requires_human_followup,
       te.root_cause_hint, te.customer_summary, te.next_best_action,
       te.most_similar_ticket_id, coalesce(te.most_similar_ticket_score, 0.0) AS most_similar_ticket_score,
       te.ticket_id IS NOT NULL AS has_ticket, r.return_id IS NOT NULL AS has_return,
       (te.ticket_id IS NOT NULL OR r.return_id IS NOT NULL OR coalesce(s.delay_hours, 0.0) > 24) AS risk_flag"""


def _mart(returns_cte: str) -> str:
    return f"""
SELECT {_MART_COLS}
FROM s_orders o
LEFT JOIN s_shipments s ON o.order_id = s.order_id
LEFT JOIN {returns_cte} r ON o.order_id = r.order_id
LEFT JOIN te ON o.order_id = te.order_id AND o.customer_id = te.customer_id"""


_KPI_LINE = (f"'- ' || {txt('issue_category')} || ': tickets=' || {txt('ticket_count')} || ', impacted_orders=' || "
             f"{txt('impacted_orders')} || ', avg_delay_hours=' || {txt('average_delay_hours')} || "
             f"', avg_refund_amount=' || {txt('average_refund_amount')}")
_HOT_LINE = (f"'- ' || {txt('city')} || ' / ' || {txt('issue_category')} || ': tickets=' || {txt('ticket_count')} "
             f"|| ', avg_delay_hours=' || {txt('average_delay_hours')}")

# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {
    "p": ([], """
SELECT * EXCLUDE (rn) FROM (
  SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey,
         l_suppkey, l_shipdate, l_quantity, l_linestatus, l_returnflag, l_discount, l_tax) AS rn
  FROM lineitem l) x WHERE rn = 1"""),
    "s_orders": (["p"], """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
       CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, upper(lower(p_type)) AS product_category,
       o_orderdate AS order_date, n_name AS city, CAST(trunc(l_quantity) AS INTEGER) AS quantity,
       p_retailprice AS unit_price, o_totalprice AS order_amount, upper(lower(o_orderstatus)) AS payment_status
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN p ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey"""),
    "s_shipments": ([], """
SELECT 'S' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS shipment_id, CAST(o_orderkey AS VARCHAR) AS order_id, s_name AS carrier,
       o_orderdate AS dispatch_time, o_orderdate + INTERVAL 5 DAY AS expected_delivery_time,
       l_shipdate AS delivery_time, delay AS delay_hours, st AS shipment_status,
       delay > 24 AS delivery_delayed_flag, st IN ('DELAYED', 'DELIVERED_DAMAGED') AS delivery_exception_flag
FROM (SELECT *, CASE WHEN delay > 24 THEN 'DELAYED' WHEN l_linestatus = 'F' THEN 'DELIVERED_DAMAGED'
                     ELSE 'DELIVERED' END AS st
      FROM (SELECT o_orderkey, l_linenumber, o_orderdate, l_shipdate, l_linestatus, s_name,
                   greatest(0.0, (epoch(l_shipdate) - epoch(o_orderdate)) / 3600.0 - 120.0) AS delay
            FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey) a) b"""),
    "s_returns": ([], """
SELECT 'R' || CAST(l_orderkey AS VARCHAR) AS return_id, CAST(l_orderkey AS VARCHAR) AS order_id,
       CASE l_orderkey % 3 WHEN 0 THEN 'WRONG_ITEM' WHEN 1 THEN 'DEFECTIVE_ITEM' ELSE 'REFUND_DELAY' END AS reason_code,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)))
            AS DOUBLE) / 10000.0 AS refund_amount,
       CASE l_orderkey % 2 WHEN 0 THEN 'REFUNDED' ELSE 'OPEN' END AS return_status,
       min(l_shipdate) AS requested_at
FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey"""),
    "s_returns_fanout": ([], """
SELECT 'R' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS return_id,
       CAST(l_orderkey AS VARCHAR) AS order_id,
       CASE l_orderkey % 3 WHEN 0 THEN 'WRONG_ITEM' WHEN 1 THEN 'DEFECTIVE_ITEM' ELSE 'REFUND_DELAY' END AS reason_code,
       CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))
            AS DOUBLE) / 10000.0 AS refund_amount,
       CASE l_orderkey % 2 WHEN 0 THEN 'REFUNDED' ELSE 'OPEN' END AS return_status,
       l_shipdate AS requested_at
FROM lineitem WHERE l_returnflag = 'R'"""),
    "s_products": ([], """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, upper(lower(p_type)) AS category,
       p_retailprice AS catalog_price
FROM part"""),
    "tk": ([], f"""
SELECT *, 'T' || CAST(event_id AS VARCHAR) AS ticket_id, CAST(event_id AS VARCHAR) AS order_id,
       CAST(CASE WHEN k >= 95 THEN o_custkey + 1 ELSE o_custkey END AS VARCHAR) AS customer_id,
       ts AS created_at, upper(lower(event_type)) AS channel, {_MSG} AS customer_message,
       'k=' || CAST(k AS VARCHAR) AS agent_notes
FROM (SELECT e.*, o_custkey, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
      FROM events e LEFT JOIN orders ON o_orderkey = event_id) x"""),
    "s_tickets": (["tk"], """
SELECT ticket_id, order_id, customer_id, created_at, channel, customer_message, agent_notes FROM tk"""),
    # k 42: no JSON; 43: prose after the object; 44: two objects; 45: single quotes; 46: a null value; 47: a missing key
    "reply": (["tk"], f"""
SELECT ticket_id, order_id, customer_id, created_at, channel, agent_notes, k,
       CASE WHEN bad THEN NULL ELSE {_category_case('k')} END AS issue_category,
       CASE WHEN bad THEN NULL WHEN k < 20 THEN 'POSITIVE' WHEN k < 50 THEN 'NEUTRAL' ELSE 'NEGATIVE' END AS sentiment,
       CASE WHEN bad THEN NULL WHEN value >= 100 THEN 'HIGH' WHEN value >= 35 THEN 'MEDIUM' ELSE 'LOW' END AS urgency,
       CASE WHEN bad THEN NULL ELSE value >= 100 END AS requires_human_followup,
       CASE WHEN bad OR k = 46 THEN NULL ELSE 'cause ' || CAST(k AS VARCHAR) END AS root_cause_hint,
       CASE WHEN bad THEN NULL ELSE customer_message END AS pii_redacted_message,
       CASE WHEN bad THEN NULL ELSE 'Ticket T' || CAST(event_id AS VARCHAR) || ' by ' || upper(event_type) END
         AS customer_summary,
       CASE WHEN bad OR k = 47 THEN NULL ELSE 'action ' || CAST(k % 5 AS VARCHAR) END AS next_best_action,
       CASE WHEN bad THEN 'unparseable reply' WHEN k = 47 THEN 'missing keys: next_best_action' END AS reply_error,
       NOT bad AS enum_ok
FROM (SELECT *, k BETWEEN 42 AND 45 AS bad FROM tk) t"""),
    "s_enrichment": (["reply"], f"""
SELECT ticket_id, order_id, customer_id, created_at, channel, issue_category, sentiment, urgency,
       requires_human_followup, root_cause_hint, {redact('pii_redacted_message')} AS pii_redacted_message,
       customer_summary, next_best_action, agent_notes, reply_error, enum_ok
FROM reply"""),
    "emb": (["s_enrichment"], """
SELECT v.ticket_id, en.order_id, en.issue_category, v.embedding, en.customer_summary, en.next_best_action
FROM (SELECT 'T' || CAST(vec_id AS VARCHAR) AS ticket_id, CAST(embedding AS DOUBLE[]) AS embedding
      FROM embeddings) v
JOIN s_enrichment en ON en.ticket_id = v.ticket_id"""),
    "sim": (["emb"], _similarity_select("emb")),
    "te": (["s_enrichment", "sim"], """
SELECT en.*, t.matched_ticket_id AS most_similar_ticket_id, t.similarity_score AS most_similar_ticket_score
FROM s_enrichment en LEFT JOIN (SELECT * FROM sim WHERE similarity_rank = 1) t ON en.ticket_id = t.ticket_id"""),
    "mart": (["s_orders", "s_shipments", "s_returns", "te"], _mart("s_returns")),
    "mart_fanout": (["s_orders", "s_shipments", "s_returns_fanout", "te"], _mart("s_returns_fanout")),
    "kpis": (["mart"], f"""
SELECT issue_category, count(ticket_id) AS ticket_count, count(DISTINCT order_id) AS impacted_orders,
       coalesce({sround('avg(delay_hours)', 2)}, 0.0) AS average_delay_hours,
       coalesce({sround('avg(order_amount)', 2)}, 0.0) AS average_order_amount,
       coalesce({sround('avg(refund_amount)', 2)}, 0.0) AS average_refund_amount
FROM mart WHERE has_ticket GROUP BY issue_category"""),
    "hotspots": (["mart"], f"""
SELECT city, issue_category, count(ticket_id) AS ticket_count,
       coalesce({sround('avg(delay_hours)', 2)}, 0.0) AS average_delay_hours
FROM mart WHERE has_ticket GROUP BY city, issue_category"""),
    "kt": (["kpis"], """
SELECT *, row_number() OVER (ORDER BY ticket_count DESC, average_delay_hours DESC NULLS LAST,
                                      issue_category ASC NULLS LAST) AS pos
FROM kpis QUALIFY pos <= 10"""),
    "ht": (["hotspots"], """
SELECT *, row_number() OVER (ORDER BY ticket_count DESC, average_delay_hours DESC NULLS LAST, city ASC NULLS LAST,
                                      issue_category ASC NULLS LAST) AS pos
FROM hotspots QUALIFY pos <= 10"""),
    "blk": (["kt", "ht"], f"""
SELECT {q(KPI_HEADER)} || coalesce(chr(10) || (SELECT string_agg({_KPI_LINE}, chr(10) ORDER BY pos) FROM kt), '')
       || chr(10) || chr(10) || {q(HOTSPOT_HEADER)}
       || coalesce(chr(10) || (SELECT string_agg({_HOT_LINE}, chr(10) ORDER BY pos) FROM ht), '') AS metrics_block"""),
    "ct": ([], """
SELECT 'C' || CAST(conv_id AS VARCHAR) AS ticket_id, CAST(conv_id AS VARCHAR) AS order_id,
       CAST(conv_id AS VARCHAR) AS customer_id, CAST(NULL AS TIMESTAMP) AS created_at, 'CHAT' AS channel,
       string_agg(text, chr(10) ORDER BY turn, text) FILTER (WHERE role = 'user') AS customer_message,
       string_agg(text, chr(10) ORDER BY turn, text) FILTER (WHERE role IS DISTINCT FROM 'user') AS agent_notes
FROM conversations GROUP BY conv_id"""),
    "ce": (["ct"], rule_enrichment_select("ct", CORPUS_RULES)),
    "re": (["s_tickets"], rule_enrichment_select("s_tickets", DEFAULT_RULES)),
    "cvec": (["ce"], f"""
SELECT e.ticket_id, e.order_id, e.issue_category, e.customer_summary, e.next_best_action,
       CAST(v.embedding AS DOUBLE[]) AS embedding
FROM ce e JOIN (
  SELECT g.ticket_id, list(coalesce(s.w, 0.0) ORDER BY g.i) AS embedding
  FROM (SELECT ticket_id, i FROM ce, range(64) r(i)) g
  LEFT JOIN (SELECT ticket_id, b, sum(w) AS w FROM (
               SELECT ticket_id, {_hex('h', 1, 4)} % 64 AS b,
                      CASE WHEN {_hex('h', 5, 1)} < 8 THEN 1.0 ELSE -1.0 END AS w
               FROM (SELECT ticket_id, md5(tok) AS h FROM (
                       SELECT ticket_id, unnest(regexp_extract_all(lower({_EMB_TEXT}), '[\\p{{L}}\\p{{N}}]+')) AS tok
                       FROM ce) t) th) sl
             GROUP BY ticket_id, b) s ON s.ticket_id = g.ticket_id AND s.b = g.i
  GROUP BY g.ticket_id) v ON v.ticket_id = e.ticket_id"""),
    "pc": (["mart"], """
SELECT city, issue_category, CAST(date_trunc('week', order_date) AS DATE) AS week, count(*) AS n,
       sum(CAST(delay_hours AS DECIMAL(18, 6))) AS delay,
       sum(CAST(CAST(delay_hours AS DECIMAL(19, 6)) * CAST(delay_hours AS DECIMAL(19, 6)) AS DECIMAL(38, 6))) AS square
FROM mart WHERE has_ticket GROUP BY 1, 2, 3"""),
    "found": (["pc"], f"""
SELECT pattern, city, issue_category, CAST(n AS BIGINT) AS tickets, {sround('observed', 4)} AS observed,
       {sround('expected', 4)} AS expected, {sround('score', 4)} AS score
FROM (SELECT *, CASE WHEN deviation > 0 THEN (observed - expected) / deviation END AS score FROM (
  SELECT 'hotspot' AS pattern, city, issue_category, n, CAST(n AS DOUBLE) AS observed, e AS expected, sqrt(e) AS deviation
  FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY city) AS DOUBLE) * CAST(sum(n) OVER (PARTITION BY issue_category) AS DOUBLE)
                  / CAST(sum(n) OVER () AS DOUBLE) AS e
        FROM (SELECT city, issue_category, sum(n) AS n FROM pc GROUP BY 1, 2) a) b
  UNION ALL
  SELECT 'delay', NULL, issue_category, n, CAST(delay AS DOUBLE) / n, mean, sqrt(greatest(square / total - mean * mean, 0.0) / n)
  FROM (SELECT issue_category, sum(n) AS n, sum(delay) AS delay FROM pc GROUP BY 1) a,
       (SELECT CAST(sum(n) AS DOUBLE) AS total, CAST(sum(delay) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS mean,
               CAST(sum(square) AS DOUBLE) AS square FROM pc) w
  UNION ALL
  SELECT 'trend', NULL, issue_category, n, CAST(n AS DOUBLE), e, sqrt(e)
  FROM (SELECT issue_category, sum(CASE WHEN week = last THEN n ELSE 0 END) AS n,
               CAST(sum(CASE WHEN week < last AND week >= last - 56 THEN n ELSE 0 END) AS DOUBLE) / 8 AS e
        FROM pc, (SELECT max(week) AS last FROM pc) w GROUP BY 1) a) f) g
WHERE n >= 5 AND {sround('score', 4)} >= 2.0"""),
    "csim": (["cvec"], _similarity_select("cvec")),
}


def with_ctes(final: str, *roots: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for r in roots:
        visit(r)
    if not order:
        return final.strip()
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{final.strip()}"


_BRIEF = f"""
SELECT concat_ws(chr(10) || chr(10),
  CASE WHEN nk > 0 THEN '# Daily operations brief: ' || c1 || ' is the highest-risk issue category'
       ELSE '# Daily operations brief: no support tickets in the gold tables' END,
  CASE WHEN nk > 0 THEN c1 || ' leads with ' || t1 || ' tickets across ' || o1 || ' impacted orders, an average delay of '
                        || d1 || ' hours and an average refund of ' || r1 || '.'
                        || CASE WHEN nh > 0 THEN ' The largest hotspot is ' || hc || ' / ' || hcat || ' with ' || ht
                                                 || ' tickets (average delay ' || hd || ' hours).' ELSE '' END
       ELSE 'No ticket metrics are available for today.' END,
  CASE WHEN nk > 0 THEN 'Prioritize the ' || c1 || ' backlog today'
                        || CASE WHEN nh > 0 THEN ', starting in ' || hc ELSE '' END || '.'
                        || CASE WHEN nk > 1 THEN ' Then review ' || c2 || ' (' || t2 || ' tickets).' ELSE '' END
       ELSE 'No action is needed today.' END,
  '## Metrics' || chr(10) || chr(10) || (SELECT metrics_block FROM blk)) AS brief
FROM (SELECT (SELECT count(*) FROM kt) AS nk, (SELECT count(*) FROM ht) AS nh,
             (SELECT {txt('issue_category')} FROM kt WHERE pos = 1) AS c1,
             (SELECT {txt('ticket_count')} FROM kt WHERE pos = 1) AS t1,
             (SELECT {txt('impacted_orders')} FROM kt WHERE pos = 1) AS o1,
             (SELECT {txt('average_delay_hours')} FROM kt WHERE pos = 1) AS d1,
             (SELECT {txt('average_refund_amount')} FROM kt WHERE pos = 1) AS r1,
             (SELECT {txt('issue_category')} FROM kt WHERE pos = 2) AS c2,
             (SELECT {txt('ticket_count')} FROM kt WHERE pos = 2) AS t2,
             (SELECT {txt('city')} FROM ht WHERE pos = 1) AS hc,
             (SELECT {txt('issue_category')} FROM ht WHERE pos = 1) AS hcat,
             (SELECT {txt('ticket_count')} FROM ht WHERE pos = 1) AS ht,
             (SELECT {txt('average_delay_hours')} FROM ht WHERE pos = 1) AS hd) v"""

_SENTENCE = """CASE pattern
  WHEN 'hotspot' THEN coalesce(city, '') || ' has ' || tickets || ' ' || coalesce(issue_category, '') || ' tickets where ' || printf('%.1f', expected) || ' are expected.'
  WHEN 'delay' THEN coalesce(issue_category, '') || ' waits ' || printf('%.1f', observed) || ' hours on average against ' || printf('%.1f', expected) || ' in all.'
  ELSE coalesce(issue_category, '') || ' has ' || tickets || ' tickets in the last week against ' || printf('%.1f', expected) || ' a week before.' END"""
_PATTERN_BRIEF = f"""
SELECT concat_ws(chr(10) || chr(10), ({_BRIEF}),
  (SELECT '## Patterns' || chr(10) || chr(10) || string_agg('- ' || line, chr(10) ORDER BY rn)
   FROM (SELECT {_SENTENCE} AS line, row_number() OVER (ORDER BY score DESC, pattern, issue_category NULLS LAST, city NULLS LAST) AS rn FROM found) l
   WHERE rn <= 5)) AS brief"""

_ISSUE_VOLUME = f"""
SELECT issue_category, count(*) AS ticket_count, {sround('avg(delay_hours)', 2)} AS average_delay_hours,
       {sround('avg(order_amount)', 2)} AS average_order_amount
FROM mart WHERE has_ticket = true GROUP BY issue_category"""
_CITY_TOP25 = f"""
SELECT city, issue_category, ticket_count, average_delay_hours FROM (
  SELECT city, issue_category, count(*) AS ticket_count, {sround('avg(delay_hours)', 2)} AS average_delay_hours
  FROM mart WHERE has_ticket = true GROUP BY city, issue_category) g
ORDER BY ticket_count DESC, average_delay_hours DESC NULLS LAST, city ASC NULLS LAST, issue_category ASC NULLS LAST
LIMIT 25"""
_SIM_PATTERNS = f"""
SELECT ticket_issue_category, matched_issue_category, count(*) AS similar_pair_count,
       {sround('avg(similarity_score)', 4)} AS average_similarity_score
FROM sim WHERE similarity_rank = 1 GROUP BY ticket_issue_category, matched_issue_category"""

def _token_slots(col: str, origin: str) -> str:
    return f"""SELECT ticket_id, {_hex('h', 1, 8)} % {SLOTS} AS slot FROM (
  SELECT ticket_id, md5({q(origin)} || tok) AS h FROM (
    SELECT ticket_id, unnest(regexp_extract_all(lower(coalesce({col}, '')), '[\\p{{L}}\\p{{N}}]+')) AS tok FROM tk) t
  WHERE NOT regexp_full_match(tok, '[0-9]{{5,}}')) x"""


def _fixed(x: str) -> str:
    return f"CAST(round(ln({x}) * {SCALE}) AS BIGINT)"


def _counted_scores() -> str:
    """Log frequencies of token places under each stored value, added up per ticket; the best value per head."""
    outputs = ", ".join(f"({q(h)}, {q(v)}, {i})" for h, values in HEADS.items() for i, v in enumerate(values))
    stored = " UNION ALL ".join(f"SELECT ticket_id, {q(h)} AS head, CAST({h} AS VARCHAR) AS value FROM whole" for h in HEADS)
    best = ", ".join(f"max(value) FILTER (WHERE head = {q(h)}) AS {h}, max(score) FILTER (WHERE head = {q(h)}) AS {h}_score" for h in HEADS)
    return f"""
, ev AS (SELECT DISTINCT ticket_id, slot FROM ({_token_slots('customer_message', 'm:')} UNION ALL {_token_slots('agent_notes', 'n:')}) u),
whole AS (SELECT * FROM reply WHERE enum_ok AND reply_error IS NULL AND {_hex('md5(ticket_id)', 1, 4)} % 5 <> 0),
stored AS ({stored}),
outs(head, value, pos) AS (VALUES {outputs}),
n AS (SELECT o.head, o.value, o.pos, count(s.ticket_id) AS n FROM outs o LEFT JOIN stored s ON s.head = o.head AND s.value = o.value
      GROUP BY o.head, o.value, o.pos),
b AS (SELECT *, {_fixed('CAST(n + 1 AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY head) + count(*) OVER (PARTITION BY head) AS DOUBLE)')} AS bias,
             {_fixed('CAST(1 AS DOUBLE) / CAST(n + 2 AS DOUBLE)')} AS never FROM n),
c AS (SELECT slot, head, value, count(*) AS c FROM ev JOIN stored USING (ticket_id) GROUP BY slot, head, value),
w AS (SELECT slot, head, value, {_fixed('CAST(c + 1 AS DOUBLE) / CAST(n + 2 AS DOUBLE)')} - never AS more FROM c JOIN b USING (head, value)),
m AS (SELECT ticket_id, head, value, sum(more) AS more FROM ev JOIN w USING (slot) GROUP BY ticket_id, head, value),
t AS (SELECT tk.ticket_id, count(ev.slot) AS places FROM tk LEFT JOIN ev ON ev.ticket_id = tk.ticket_id GROUP BY tk.ticket_id),
s AS (SELECT t.ticket_id, b.head, b.value, b.pos, CAST(bias + places * never + coalesce(more, 0) AS BIGINT) AS score
      FROM t CROSS JOIN b LEFT JOIN m ON m.ticket_id = t.ticket_id AND m.head = b.head AND m.value = b.value),
r AS (SELECT *, row_number() OVER (PARTITION BY ticket_id, head ORDER BY score DESC, pos) AS rn FROM s)
SELECT ticket_id, {best} FROM r WHERE rn = 1 GROUP BY ticket_id"""


_REPLY_COLS = ("ticket_id, issue_category, sentiment, urgency, requires_human_followup, root_cause_hint, "
               "pii_redacted_message, customer_summary, next_best_action, reply_error, enum_ok")
_ENRICH_COLS = ("ticket_id, order_id, customer_id, created_at, channel, issue_category, sentiment, urgency, "
                "requires_human_followup, root_cause_hint, pii_redacted_message, customer_summary, next_best_action, "
                "agent_notes, reply_error, enum_ok")
_SIM_COLS = ("ticket_id, matched_ticket_id, ticket_issue_category, matched_issue_category, similarity_rank, "
             "similarity_score, ticket_summary, matched_ticket_summary, recommended_action_pattern")


def _stage_counts() -> str:
    parts = [
        ("support_tickets", "s_tickets"), ("ticket_enrichment", "s_enrichment"), ("ticket_embeddings", "emb"),
        ("ticket_similarity", "sim"), ("order_support_360", "mart"), ("issue_kpis", "kpis"),
        ("city_issue_hotspots", "hotspots"), ("brief_kpi_rows", "kt"), ("brief_hotspot_rows", "ht"),
    ]
    return "\nUNION ALL\n".join(f"SELECT {q(n)} AS stage, count(*) AS row_count FROM {t}" for n, t in parts)


ORACLE_SQL: dict[str, str] = {
    "standardize_orders": with_ctes("SELECT * FROM s_orders", "s_orders"),
    "standardize_shipments": with_ctes("SELECT * FROM s_shipments", "s_shipments"),
    "standardize_returns": with_ctes("SELECT * FROM s_returns", "s_returns"),
    "standardize_products": with_ctes("SELECT * FROM s_products", "s_products"),
    "standardize_tickets": with_ctes("SELECT * FROM s_tickets", "s_tickets"),
    "shipment_flags": with_ctes(
        "SELECT shipment_id, delay_hours, shipment_status, delivery_delayed_flag, delivery_exception_flag "
        "FROM s_shipments", "s_shipments"),
    "redact_pii": f"SELECT doc_id, {redact('text')} AS redacted_text FROM documents",
    "parse_model_reply": with_ctes(f"SELECT {_REPLY_COLS} FROM reply", "reply"),
    "ticket_prompt": with_ctes(f"SELECT ticket_id, {_PROMPT} AS prompt FROM ct", "ct"),
    "embedding_text": with_ctes(f"SELECT ticket_id, {_EMB_TEXT} AS embedding_text FROM ce", "ce"),
    "ticket_enrichment": with_ctes(f"SELECT {_ENRICH_COLS} FROM s_enrichment", "s_enrichment"),
    "conversation_enrichment": with_ctes(f"SELECT {_ENRICH_COLS} FROM ce", "ce"),
    "ticket_rule_enrichment": with_ctes(f"SELECT {_ENRICH_COLS} FROM re", "re"),
    "counted_reply_scores": with_ctes(_counted_scores(), "reply"),
    "conversation_term_weights": with_ctes(f"""
SELECT slot, texts, {sround('ln(CAST((SELECT count(*) FROM ce) + 1 AS DOUBLE) / CAST(texts + 1 AS DOUBLE)) + 1', 9)} AS idf
FROM (SELECT CAST({_hex('h', 1, 8)} % {LATENT_SLOTS} AS INTEGER) AS slot, count(DISTINCT ticket_id) AS texts
      FROM (SELECT ticket_id, md5(unnest(regexp_extract_all(lower({_EMB_TEXT}), '[\\p{{L}}\\p{{N}}]+'))) AS h FROM ce) t
      GROUP BY 1) c""", "ce"),
    "hashed_embedding": with_ctes("SELECT ticket_id, order_id, issue_category, embedding FROM cvec", "cvec"),
    "ticket_similarity_top3": with_ctes(f"SELECT {_SIM_COLS} FROM sim", "sim"),
    "conversation_similarity_top3": with_ctes(f"SELECT {_SIM_COLS} FROM csim", "csim"),
    "pivot_similarity_top3": with_ctes(f"SELECT {_SIM_COLS} FROM sim", "sim"),
    "top_similarity_per_ticket": with_ctes(
        "SELECT ticket_id, matched_ticket_id, similarity_score, similarity_rank FROM sim WHERE similarity_rank = 1",
        "sim"),
    "order_support_360": with_ctes("SELECT * FROM mart", "mart"),
    "order_support_360_fanout": with_ctes("SELECT * FROM mart_fanout", "mart_fanout"),
    "issue_kpis": with_ctes("SELECT * FROM kpis", "kpis"),
    "city_issue_hotspots": with_ctes("SELECT * FROM hotspots", "hotspots"),
    "weekly_issue_kpis": with_ctes(f"""
SELECT CAST(date_trunc('week', order_date) AS DATE) AS week, issue_category, count(ticket_id) AS ticket_count,
       count(DISTINCT order_id) AS impacted_orders, {_decimal_mean('delay_hours')} AS average_delay_hours,
       {_decimal_mean('order_amount')} AS average_order_amount, {_decimal_mean('refund_amount')} AS average_refund_amount
FROM mart WHERE has_ticket GROUP BY 1, 2""", "mart"),
    "issue_volume_by_category": with_ctes(_ISSUE_VOLUME, "mart"),
    "city_hotspots_top25": with_ctes(_CITY_TOP25, "mart"),
    "high_risk_orders": with_ctes(
        "SELECT order_id, customer_id, city, product_name, carrier, shipment_status, delay_hours, issue_category, "
        "urgency, root_cause_hint, next_best_action FROM mart WHERE risk_flag = true", "mart"),
    "similarity_patterns": with_ctes(_SIM_PATTERNS, "sim"),
    "brief_kpi_top10": with_ctes(
        "SELECT issue_category, ticket_count, impacted_orders, average_delay_hours, average_order_amount, "
        "average_refund_amount FROM kt", "kt"),
    "brief_hotspot_top10": with_ctes(
        "SELECT city, issue_category, ticket_count, average_delay_hours FROM ht", "ht"),
    "issue_volume_by_category_sql": with_ctes(_ISSUE_VOLUME, "mart"),
    "city_hotspots_top25_sql": with_ctes(_CITY_TOP25, "mart"),
    "similarity_patterns_sql": with_ctes(_SIM_PATTERNS, "sim"),
    "high_risk_orders_sql": with_ctes(
        "SELECT order_id, customer_id, city, product_name, carrier, shipment_status, delay_hours, issue_category, "
        "urgency, root_cause_hint, next_best_action FROM mart WHERE risk_flag = true", "mart"),
    "brief_kpi_top10_sql": with_ctes(
        "SELECT issue_category, ticket_count, impacted_orders, average_delay_hours, average_order_amount, "
        "average_refund_amount FROM kt", "kt"),
    "brief_hotspot_top10_sql": with_ctes(
        "SELECT city, issue_category, ticket_count, average_delay_hours FROM ht", "ht"),
    "brief_kpi_top10_text": with_ctes(
        "SELECT " + ", ".join(f"{txt(c)} AS {c}" for c in [
            "issue_category", "ticket_count", "impacted_orders", "average_delay_hours", "average_order_amount",
            "average_refund_amount"]) + " FROM kt", "kt"),
    "metrics_block": with_ctes("SELECT metrics_block FROM blk", "blk"),
    "brief_prompt": with_ctes(f"SELECT {strip(q(BRIEF_PROMPT_HEAD) + ' || metrics_block')} AS prompt FROM blk", "blk"),
    "daily_brief": with_ctes(_BRIEF, "blk", "kt", "ht"),
    "issue_patterns": with_ctes("SELECT * FROM found", "found"),
    "pattern_brief": with_ctes(_PATTERN_BRIEF, "blk", "kt", "ht", "found"),
    "stage_row_counts": with_ctes(_stage_counts(), "s_tickets", "s_enrichment", "emb", "sim", "mart", "kpis",
                                  "hotspots", "kt", "ht"),
}
