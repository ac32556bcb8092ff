"""Raw support tables derived from the benchmark's TPC-H-like Parquet tables.

The benchmark ships orders, line items, customers, parts, suppliers, an event
stream, conversations and embedding vectors, not retail-support files. These
functions map them onto the raw support schemas (all text, like the CSV and
JSON-lines files the pipeline ingests), with Spark doing all the work so the
cost grows with the tables. Every row of every source table is used; nothing
is sampled or filtered by id. DuckDB definitions of the same tables live in
``caseloom.plans.oracle``.

* orders: one per TPC-H order; product = the order's primary line (highest
  extended price, ties broken by the remaining line columns).
* shipments: one per line of an order; delay = hours from order date to that
  line's ship date beyond a 5-day promise.
* returns: one per order with returned ('R') lines, refund summed in integer
  cents; ``returns_fanout`` keeps one row per returned line (SEM-9).
* support tickets: one per event (event ids lie in the order-key range); the
  event's JSON props carry ``k``, which drives the simulated model reply; a
  ticket with k >= 95 names another customer than its order (SEM-10).
* conversation tickets: one per conversation; all user turns in order =
  message, all other turns in order = agent notes.
* embeddings: the benchmark's vectors, vector i standing for ticket ``T<i>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.operators.enrich import RuleSet, word
from caseloom.schemas import ISSUE_CATEGORIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

PROMISED_DELIVERY_DAYS = 5
TASKS_PER_CORE = 4
_TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table; its files are listed anew at every call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts_text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, _TS_TEXT)


def text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def primary_lines(lineitem: DataFrame) -> DataFrame:
    """The line with the highest extended price per order (total order on ties).

    ``row_number() = 1`` plans as a WindowGroupLimit on each side of the
    shuffle, so every map task keeps one line per order before anything moves
    (a hot order key costs one row per task, not one task)."""
    w = Window.partitionBy("l_orderkey").orderBy(
        F.col("l_extendedprice").desc(), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
        "l_linestatus", "l_returnflag", "l_discount", "l_tax")
    return lineitem.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _hours_between(start: str, end: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(start), F.col(end)) / F.lit(3600.0)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions are attached to the narrow sides first; the last join is by the text order id, so the result is
    already partitioned the way the mart joins it. Left joins: no order vanishes here for a missing dimension row."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey").join(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    lines = primary_lines(table(spark, sf_dir, "lineitem")).select("l_orderkey", "l_partkey", "l_quantity").join(
        part, F.col("l_partkey") == F.col("p_partkey"), "left").withColumn("_line_order", text("l_orderkey"))
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").withColumn(
        "_order", text("o_orderkey"))
    df = orders.join(lines, F.col("_order") == F.col("_line_order"), "left")
    return df.select(
        F.col("_order").alias("order_id"),
        text("o_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        text("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lower("p_type").alias("product_category"),
        ts_text("o_orderdate").alias("order_date"),
        F.col("n_name").alias("city"),
        text(F.col("l_quantity").cast("int")).alias("quantity"),
        text("p_retailprice").alias("unit_price"),
        text("o_totalprice").alias("order_amount"),
        F.lower("o_orderstatus").alias("payment_status"),
    )


def raw_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every order ships on its own."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_linestatus")
    df = (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("_delay", F.greatest(F.lit(0.0), _hours_between("o_orderdate", "l_shipdate")
                                         - F.lit(24.0 * PROMISED_DELIVERY_DAYS)))
    )
    status = (
        F.when(F.col("_delay") > 24, "delayed")
        .when(F.col("l_linestatus") == "F", "delivered_damaged")
        .otherwise("delivered")
    )
    return df.select(
        F.concat(F.lit("S"), text("o_orderkey"), F.lit("-"), text("l_linenumber")).alias("shipment_id"),
        text("o_orderkey").alias("order_id"),
        F.col("s_name").alias("carrier"),
        ts_text("o_orderdate").alias("dispatch_time"),
        ts_text(F.timestamp_add("DAY", F.lit(PROMISED_DELIVERY_DAYS), F.col("o_orderdate"))).alias(
            "expected_delivery_time"),
        ts_text("l_shipdate").alias("delivery_time"),
        text("_delay").alias("delay_hours"),
        status.alias("shipment_status"),
    )


def _reason(orderkey: Column) -> Column:
    m = F.pmod(orderkey, F.lit(3))
    return F.when(m == 0, "wrong_item").when(m == 1, "defective_item").otherwise("refund_delay")


def _cents(price: Column, discount: Column) -> Column:
    """Net amount in 1/10000 units, integer arithmetic (exact in both engines)."""
    return F.round(price * 100).cast("long") * (F.lit(100) - F.round(discount * 100).cast("long"))


def raw_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    agg = returned.groupBy("l_orderkey").agg(
        F.sum(_cents(F.col("l_extendedprice"), F.col("l_discount"))).alias("_units"),
        F.min("l_shipdate").alias("_requested"),
    )
    return agg.select(
        F.concat(F.lit("R"), text("l_orderkey")).alias("return_id"),
        text("l_orderkey").alias("order_id"),
        _reason(F.col("l_orderkey")).alias("reason_code"),
        text(F.col("_units").cast("double") / F.lit(10000.0)).alias("refund_amount"),
        F.when(F.pmod(F.col("l_orderkey"), F.lit(2)) == 0, "refunded").otherwise("open").alias("return_status"),
        ts_text("_requested").alias("requested_at"),
    )


def raw_returns_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One return per returned line: several returns per order (SEM-9)."""
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return returned.select(
        F.concat(F.lit("R"), text("l_orderkey"), F.lit("-"), text("l_linenumber")).alias("return_id"),
        text("l_orderkey").alias("order_id"),
        _reason(F.col("l_orderkey")).alias("reason_code"),
        text(_cents(F.col("l_extendedprice"), F.col("l_discount")).cast("double") / F.lit(10000.0)).alias(
            "refund_amount"),
        F.when(F.pmod(F.col("l_orderkey"), F.lit(2)) == 0, "refunded").otherwise("open").alias("return_status"),
        ts_text("l_shipdate").alias("requested_at"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        text("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lower("p_type").alias("category"),
        text("p_retailprice").alias("catalog_price"),
    )


def _category_of(k: Column) -> Column:
    m = F.pmod(k, F.lit(len(ISSUE_CATEGORIES)))
    out = F.lit(None).cast("string")
    for i, name in reversed(list(enumerate(ISSUE_CATEGORIES))):
        out = F.when(m == i, F.lit(name)).otherwise(out)
    return out


def _message(k: Column, event_id: Column, user_id: Column, event_type: Column) -> Column:
    order = text(event_id)
    phone = F.concat(F.lit("98"), F.lpad(text(F.pmod(event_id, F.lit(100000000))), 8, "0"))
    return (
        F.when(F.pmod(k, F.lit(10)) == 3,
               F.concat(F.lit("Please call me on "), phone, F.lit(" about order "), order, F.lit(".")))
        .when(F.pmod(k, F.lit(10)) == 6,
              F.concat(F.lit("Write to buyer."), text(user_id), F.lit("@shop-mail.com about order "), order,
                       F.lit(".")))
        .otherwise(F.concat(F.upper(F.substring(event_type, 1, 1)), F.lower(F.substring(event_type, 2, 1 << 30)),
                            F.lit(" problem with order "), order, F.lit(".")))
    )


def event_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw support tickets (text columns) plus the simulated model ``reply``."""
    events = table(spark, sf_dir, "events")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    df = events.join(orders, F.col("event_id") == F.col("o_orderkey"), "left")
    # an event is a few bytes on disk and much work as a ticket: dealt out anew, or a file of millions is one task's
    df = df.repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism).withColumn("_k", k)
    df = df.withColumn("customer_message", _message(F.col("_k"), F.col("event_id"), F.col("user_id"),
                                                    F.col("event_type")))
    # every step is a column of its own: a step that names one before it several times would else hold as many copies of
    # it, too much code for the JVM to compile
    df = df.withColumn("_json", F.to_json(F.struct(
        _category_of(F.col("_k")).alias("issue_category"),
        F.when(F.col("_k") < 20, "POSITIVE").when(F.col("_k") < 50, "NEUTRAL").otherwise("NEGATIVE")
        .alias("sentiment"),
        F.when(F.col("value") >= 100, "HIGH").when(F.col("value") >= 35, "MEDIUM").otherwise("LOW")
        .alias("urgency"),
        (F.col("value") >= 100).alias("requires_human_followup"),
        F.when(F.col("_k") != 46, F.concat(F.lit("cause "), text("_k"))).alias("root_cause_hint"),
        F.col("customer_message").alias("pii_redacted_message"),
        F.concat(F.lit("Ticket T"), text("event_id"), F.lit(" by "), F.upper("event_type")).alias(
            "customer_summary"),
        F.concat(F.lit("action "), text(F.pmod(F.col("_k"), F.lit(5)))).alias("next_best_action"),
    ), {"ignoreNullFields": "false"}))
    reply = F.col("_json")
    # what models also send: prose after the object, a second object, single quotes, a null value (k = 46, above),
    # a key left out
    df = df.withColumn("_sent", (
        F.when(F.col("_k") == 43, F.concat(reply, F.lit(" I hope this helps.")))
        .when(F.col("_k") == 44, F.concat(reply, F.lit(" "), reply))
        .when(F.col("_k") == 45, F.translate(reply, '"', "'"))
        .when(F.col("_k") == 47, F.regexp_replace(reply, r',"next_best_action":"[^"]*"', ""))
        .otherwise(reply)
    ))
    reply = F.col("_sent")
    fence = F.pmod(F.col("event_id"), F.lit(3))
    reply_text = (
        F.when(F.col("_k") == 42, F.lit("Sorry, I can not classify this ticket."))
        .when(fence == 1, F.concat(F.lit("```json\n"), reply, F.lit("\n```")))
        .when(fence == 2, F.concat(F.lit("  ```\n"), reply, F.lit("\n```  \n")))
        .otherwise(reply)
    )
    return df.select(
        F.concat(F.lit("T"), text("event_id")).alias("ticket_id"),
        text("event_id").alias("order_id"),
        text(F.when(F.col("_k") >= 95, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))).alias(
            "customer_id"),
        ts_text("ts").alias("created_at"),
        F.lower("event_type").alias("channel"),
        F.col("customer_message"),
        F.concat(F.lit("k="), text("_k")).alias("agent_notes"),
        reply_text.alias("reply"),
    )


def conversation_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text tickets: every turn of a conversation, the user's as message, all others as agent notes.

    A conversation's turns meet in one row, which the ticket's text holds anyway."""
    conv = table(spark, sf_dir, "conversations")

    def turns(mine: Column) -> Column:
        found = F.sort_array(F.collect_list(F.when(mine & F.col("text").isNotNull(), F.struct("turn", "text"))))
        return F.when(F.size(found) > 0, F.array_join(F.transform(found, lambda t: t["text"]), "\n"))

    user = F.coalesce(F.col("role") == "user", F.lit(False))
    agg = conv.groupBy("conv_id").agg(turns(user).alias("_message"), turns(~user).alias("_notes"))
    return agg.select(
        F.concat(F.lit("C"), text("conv_id")).alias("ticket_id"),
        text("conv_id").alias("order_id"),
        text("conv_id").alias("customer_id"),
        F.lit(None).cast("string").alias("created_at"),
        F.lit("chat").alias("channel"),
        F.col("_message").alias("customer_message"),
        F.col("_notes").alias("agent_notes"),
    )


def ticket_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored model vectors: vector ``i`` belongs to ticket ``T<i>``."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.concat(F.lit("T"), text("vec_id")).alias("ticket_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


# Rules for the synthetic multilingual conversation corpus: its prose is
# invented, so the default English retail rules would classify everything as a
# general query. These match frequent syllables of that corpus instead.
CORPUS_RULES = RuleSet(
    categories=[
        ("DELIVERY_DELAY", word("the")),
        ("DAMAGED_ITEM", r"sch"),
        ("WRONG_ITEM_SENT", word("que")),
        ("DELIVERY_EXCEPTION", r"tion"),
        ("REFUND_DELAY", word("und")),
        ("PAYMENT_ISSUE", r"eaux"),
        ("RETURN_PICKUP_DELAY", r"ment"),
        ("REPLACEMENT_REQUEST", r"ción"),
    ],
    sentiments=[("NEGATIVE", word("(nicht|pas|no)")), ("POSITIVE", word("(that|das)"))],
    urgencies=[("HIGH", word("(was|ist)"))],
)
