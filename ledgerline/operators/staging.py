"""Staging models (PRJ-1..3, SNK-5): rename, type and filter raw text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STAGING_VIEWS = {"calls": "stg_calls", "payments": "stg_payments", "jobs": "stg_jobs"}


# Each staging model is a row condition plus named column expressions over
# its raw table, so it can be applied as a view or evaluated inline (the
# data-test suite checks raw and staging columns in one scan).

def calls_spec() -> tuple[Column, dict[str, Column]]:
    keep = F.col("call_id").isNotNull() & F.col("timestamp").isNotNull()
    return keep, {
        "call_id": F.col("call_id"),
        "call_timestamp": F.col("timestamp").cast("timestamp_ntz"),
        "caller_name": F.col("caller_name"),
        "caller_phone": F.col("caller_phone"),
        "urgency": F.col("urgency"),
        "topic": F.col("topic"),
        "outcome": F.col("outcome"),
        "duration_seconds": F.col("duration_seconds").cast("int"),
        "sentiment_score": F.col("sentiment_score").cast("decimal(3,2)"),
        "agent_id": F.col("agent_id"),
    }


def payments_spec() -> tuple[Column, dict[str, Column]]:
    keep = F.col("payment_id").isNotNull() & (F.col("status") != "failed")
    cents = F.col("amount_cents").cast("int")
    return keep, {
        "payment_id": F.col("payment_id"),
        "payment_timestamp": F.col("timestamp").cast("timestamp_ntz"),
        "amount_cents": cents,
        "amount_dollars": F.round(cents.cast("decimal(18,0)") / F.lit(100), 2).cast("decimal(18,2)"),
        "currency": F.col("currency"),
        "status": F.col("status"),
        "payment_method": F.col("payment_method"),
        "customer_email": F.col("customer_email"),
        "service_description": F.col("description"),
        "metadata_source": F.col("metadata_source"),
    }


def jobs_spec() -> tuple[Column, dict[str, Column]]:
    keep = F.col("job_id").isNotNull()
    return keep, {
        "job_id": F.col("job_id"),
        "related_call_id": F.col("related_call_id"),
        "job_status": F.col("status"),
        "service_category": F.col("service_category"),
        "job_value": F.col("value").cast("decimal(10,2)"),
        "technician": F.col("technician"),
        "scheduled_at": F.col("scheduled_at").cast("timestamp_ntz"),
        "completed_at": F.nullif(F.col("completed_at"), F.lit("")).cast("timestamp_ntz"),
    }


STAGING_SPECS = {"calls": calls_spec, "payments": payments_spec, "jobs": jobs_spec}


def _apply(raw: DataFrame, spec) -> DataFrame:
    keep, cols = spec()
    return raw.where(keep).select(*[e.alias(n) for n, e in cols.items()])


def stg_calls(raw: DataFrame) -> DataFrame:
    return _apply(raw, calls_spec)


def stg_payments(raw: DataFrame) -> DataFrame:
    return _apply(raw, payments_spec)


def stg_jobs(raw: DataFrame) -> DataFrame:
    return _apply(raw, jobs_spec)


def inline_views() -> dict[str, tuple[str, Column, dict[str, Column]]]:
    """Staging model -> (raw model, row condition, column expressions)."""
    out = {}
    for name, spec in STAGING_SPECS.items():
        keep, cols = spec()
        out[STAGING_VIEWS[name]] = (f"raw.{name}", keep, cols)
    return out


STAGING_MODELS = {"calls": stg_calls, "payments": stg_payments, "jobs": stg_jobs}


def staging(raw):
    """Source name -> staging DataFrame (defined on first access)."""
    from ledgerline.plans.lazy import LazyMap

    return LazyMap(raw, lambda name: STAGING_MODELS[name](raw[name]))


def register_staging(spark: SparkSession, raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging models are views: lazily recomputed from raw on every read."""
    out = {}
    for name, df in staging(raw).items():
        df.createOrReplaceTempView(STAGING_VIEWS[name])
        out[name] = spark.table(STAGING_VIEWS[name])
    return out
