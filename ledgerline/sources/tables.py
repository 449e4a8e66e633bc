"""Operational extracts projected from the benchmark tables.

The three operational sources (calls, payments, jobs) are derived from the
``events``, ``lineitem``/``part`` and ``orders`` tables with column
expressions only, so every downstream job scales with those tables.
Values are emitted as the source systems would send them (numbers and
timestamps as text), ready for the raw load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Service topic per bucket (calls: user_id % 10, jobs: o_custkey % 10).
TOPICS = [
    "boiler service", "window repair", "floor sanding", "alarm check", "chimney sweep",
    "tile work", "door fitting", "garden drainage", "kitchen refit", "paint job",
]

# Event type -> call outcome.
OUTCOME_BY_EVENT = {
    "purchase": "booked",
    "signup": "qualified",
    "error": "escalated",
    "click": "missed",
    "view": "resolved",
}

# Lineitem flags -> payment status / method, order status -> job status.
STATUS_BY_RETURNFLAG = {"A": "succeeded", "R": "refunded", "N": "failed"}
METHOD_BY_LINESTATUS = {"F": "card", "O": "ach"}
JOB_STATUS_BY_ORDERSTATUS = {"F": "completed", "O": "scheduled", "P": "cancelled"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lookup(c: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr


def topic_of(key: Column) -> Column:
    """Topic of a key's bucket (a null key: the last topic)."""
    bucket = key % len(TOPICS)
    expr = F.when(bucket == 0, TOPICS[0])
    for i, t in enumerate(TOPICS[1:-1], start=1):
        expr = expr.when(bucket == i, t)
    return expr.otherwise(TOPICS[-1])


def call_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events + k (from the JSON props) + topic (from the user bucket)."""
    ev = read_table(spark, sf_dir, "events")
    topic = topic_of(F.col("user_id"))
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        topic.alias("topic"),
    )


def _calls_from(ev: DataFrame, damaged: bool = False) -> DataFrame:
    k = F.col("k")
    urgency = (F.when(k < 30, "low").when(k < 75, "medium")
               .when(k < 95, "high").otherwise("critical"))
    outcome = _lookup(F.col("event_type"), OUTCOME_BY_EVENT)
    if damaged:
        # urgency missing where k % 10 = 0, outcome outside the domain where k = 0
        urgency = F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(urgency)
        outcome = F.when(k == 0, F.lit("unknown")).otherwise(outcome)
    return ev.select(
        F.col("event_id").cast("string").alias("call_id"),
        F.col("ts").cast("string").alias("timestamp"),
        F.concat(F.lit("Caller "), (F.col("user_id") % 15).cast("string")).alias("caller_name"),
        F.concat(F.lit("+1"), (F.lit(2000000000) + F.col("user_id")).cast("string")).alias("caller_phone"),
        urgency.alias("urgency"),
        F.col("topic"),
        outcome.alias("outcome"),
        (F.lit(15) + F.floor("value").cast("int")).cast("string").alias("duration_seconds"),
        ((F.lit(30) + k % 71) / F.lit(100)).cast("decimal(3,2)").cast("string").alias("sentiment_score"),
        F.concat(F.lit("agent-"), (F.col("user_id") % 3 + 1).cast("string")).alias("agent_id"),
    )


def calls_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls_from(call_events(spark, sf_dir))


def payments_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return payments_from_lines(li, part)


def _jobs_from(orders: DataFrame, suffix: str = "") -> DataFrame:
    """Every order is a job of the call with its number, whether that call exists or not."""
    status = _lookup(F.col("o_orderstatus"), JOB_STATUS_BY_ORDERSTATUS)
    return orders.select(
        F.concat(F.lit("job_"), F.col("o_orderkey").cast("string"), F.lit(suffix)).alias("job_id"),
        F.col("o_orderkey").cast("string").alias("related_call_id"),
        status.alias("status"),
        topic_of(F.col("o_custkey")).alias("service_category"),
        F.col("o_totalprice").cast("decimal(10,2)").cast("string").alias("value"),
        F.concat(F.lit("tech-"), (F.col("o_custkey") % 8).cast("string")).alias("technician"),
        F.col("o_orderdate").cast("string").alias("scheduled_at"),
        F.when(F.col("o_orderstatus") == "F",
               (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).cast("string"))
         .otherwise(F.lit("")).alias("completed_at"),
    )


def jobs_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _jobs_from(read_table(spark, sf_dir, "orders"))


EXTRACTS = {"calls": calls_extract, "payments": payments_extract, "jobs": jobs_extract}


def extracts(spark: SparkSession, sf_dir: str):
    """Source name -> extract DataFrame, each defined on first access."""
    from ledgerline.plans.lazy import LazyMap

    return LazyMap(EXTRACTS, lambda name: EXTRACTS[name](spark, sf_dir))


# ---------------------------------------------------------------------------
# Damaged copies: the clean projections pass every check, these give the
# data-quality and consistency operators something to find.
# ---------------------------------------------------------------------------

def damaged_calls_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls_from(call_events(spark, sf_dir), damaged=True)


def damaged_payments_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    # payments plus a second copy of every first line item (duplicate ids)
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return payments_from_lines(li, part, copies=F.when(F.col("l_linenumber") == 1, 2).otherwise(1))


def damaged_jobs_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a second job for the call of every seventh order
    orders = read_table(spark, sf_dir, "orders")
    return _jobs_from(orders).unionByName(_jobs_from(orders.where(F.col("o_orderkey") % 7 == 0), "_b"))


DAMAGED_EXTRACTS = {"calls": damaged_calls_extract, "payments": damaged_payments_extract,
                    "jobs": damaged_jobs_extract}


def damaged_extracts(spark: SparkSession, sf_dir: str):
    from ledgerline.plans.lazy import LazyMap

    return LazyMap(DAMAGED_EXTRACTS, lambda name: DAMAGED_EXTRACTS[name](spark, sf_dir))


def payments_from_lines(li: DataFrame, part: DataFrame, copies: Column | None = None) -> DataFrame:
    """Payments of line items; ``copies`` of each, if given, made of the finished row."""
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    payments = j.select(
        F.concat_ws("_", F.lit("pi"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("payment_id"),
        F.col("l_shipdate").cast("string").alias("timestamp"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string").alias("amount_cents"),
        F.lit("usd").alias("currency"),
        _lookup(F.col("l_returnflag"), STATUS_BY_RETURNFLAG).alias("status"),
        _lookup(F.col("l_linestatus"), METHOD_BY_LINESTATUS).alias("payment_method"),
        F.concat(F.lit("customer"), (F.lit(100) + F.col("l_orderkey") % 900).cast("string"),
                 F.lit("@example.com")).alias("customer_email"),
        F.col("p_type").alias("description"),
        F.lit("booking").alias("metadata_source"),
        *([] if copies is None else [F.array_repeat(F.lit(True), copies).alias("_copies")]),
    )
    return payments if copies is None else payments.select(*payments.columns[:-1], F.explode("_copies")).drop("col")
