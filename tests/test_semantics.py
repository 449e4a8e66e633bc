"""Hand-computed literals for the rounding, NULL-ordering and cast traps."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions.numeric import avg_half_up, half_up_div, pct
from ledgerline.operators import joins, marts, staging
from ledgerline.operators.raw import to_raw
from ledgerline.schemas import CALL_COLUMNS, JOB_COLUMNS, PAYMENT_COLUMNS


def test_half_up_ties_and_zero_denominator(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (5, 0), (-1, 8), (7, 2)], "a long, b long")
    got = df.select(pct(F.col("a"), F.col("b")).alias("p"),
                    half_up_div(F.col("a"), F.col("b"), 0).alias("r0")).collect()
    assert [r.p for r in got] == [Decimal("12.5"), Decimal("33.3"), Decimal("66.7"), None,
                                  Decimal("-12.5"), Decimal("350.0")]
    # 7/2 = 3.5 -> 4 (half away from zero), -1/8 -> -0.125 -> 0 at 0 digits
    assert [r.r0 for r in got] == [Decimal("0"), Decimal("0"), Decimal("1"), None, Decimal("0"), Decimal("4")]


def test_avg_of_decimals_rounds_exact_ties(spark):
    # avg(0.10, 0.11, 0.11, 0.12, 0.11, 0.10, 0.11, 0.12) = 0.1100; avg(0.01, 0.02) = 0.015 -> 0.02
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),)], "x decimal(3,2)")
    v = df.agg(avg_half_up(F.sum("x"), F.count("x"), 2, scale=2).alias("a")).first().a
    assert v == Decimal("0.02")


def _raw_calls(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CALL_COLUMNS))
    return to_raw(df, CALL_COLUMNS, dt.datetime(2024, 2, 1))


def test_staging_casts_and_filters(spark):
    calls = _raw_calls(spark, [
        ("1", "2024-01-01 10:00:00", "a", "p", "low", "t", "booked", "30", "0.345", "agent-1"),
    ])
    row = staging.stg_calls(calls).first()
    assert row.sentiment_score == Decimal("0.35")
    assert row.call_timestamp == dt.datetime(2024, 1, 1, 10, 0)
    pays = to_raw(spark.createDataFrame([
        ("p1", "2024-01-01 00:00:00", "1999", "usd", "succeeded", "card", "e", "s", "b"),
        ("p2", "2024-01-01 00:00:00", "500", "usd", "failed", "card", "e", "s", "b"),
        ("p3", "2024-01-01 00:00:00", "500", "usd", None, "card", "e", "s", "b"),
    ], ", ".join(f"{c} string" for c in PAYMENT_COLUMNS)), PAYMENT_COLUMNS, dt.datetime(2024, 2, 1))
    sp = staging.stg_payments(pays).collect()
    # failed dropped; a missing status is loaded as '' (raw text is never NULL) and kept
    assert sorted(r.payment_id for r in sp) == ["p1", "p3"]
    assert [r.amount_dollars for r in sp if r.payment_id == "p1"] == [Decimal("19.99")]
    jobs = to_raw(spark.createDataFrame([
        ("j1", "1", "scheduled", "x", "10.50", "t", "2024-01-01 00:00:00", ""),
    ], ", ".join(f"{c} string" for c in JOB_COLUMNS)), JOB_COLUMNS, dt.datetime(2024, 2, 1))
    assert staging.stg_jobs(jobs).first().completed_at is None


def test_mart_jobs_orders_nulls_first(spark):
    jobs = spark.createDataFrame([
        ("j1", "1", "completed", "a", Decimal("10.00")),
        ("j2", "2", "scheduled", "b", Decimal("99.00")),
        ("j3", "3", "completed", "c", Decimal("20.00")),
    ], "job_id string, related_call_id string, job_status string, service_category string, job_value decimal(10,2)")
    rows = marts.ordered_mart(marts.mart_jobs(jobs), "mart_jobs").collect()
    assert [r.service_category for r in rows] == ["b", "c", "a"]
    assert rows[0].total_completed_value is None and rows[0].avg_completed_value is None
    assert rows[0].completion_rate_pct == Decimal("0.0")


def test_fused_funnel_equals_reference_shape(spark):
    t = dt.datetime
    calls = spark.createDataFrame([
        ("1", t(2024, 1, 1, 9), "booked", 10, Decimal("0.50")),
        ("2", t(2024, 1, 1, 10), "missed", 21, Decimal("0.61")),
        ("3", t(2024, 1, 2, 9), "booked", 30, None),
        ("3", t(2024, 1, 2, 11), "qualified", 31, Decimal("0.90")),  # duplicated call id
    ], "call_id string, call_timestamp timestamp_ntz, outcome string, duration_seconds int, "
       "sentiment_score decimal(3,2)")
    jobs = spark.createDataFrame([
        ("j1", "1", "completed"), ("j2", "1", "cancelled"), ("j3", "3", "completed"), ("j4", "9", "completed"),
    ], "job_id string, related_call_id string, job_status string")
    fused = marts.mart_call_funnel(calls, jobs).orderBy("call_date").collect()
    ref = marts._with_rates(joins.with_jobs(
        marts.call_funnel_counts(calls), joins.jobs_by_call_day(calls, jobs))).orderBy("call_date").collect()
    assert fused == ref
    d1, d2 = fused
    assert (d1.total_calls, d1.total_jobs, d1.completed_jobs, d1.cancelled_jobs) == (2, 2, 1, 1)
    assert d1.avg_duration_seconds == Decimal("15.5") and d1.avg_sentiment == Decimal("0.56")
    assert (d2.total_jobs, d2.completed_jobs) == (2, 2)  # each duplicate call row sees the job
    assert d1.booking_rate_pct == Decimal("50.0")


def test_revenue_identity(spark):
    pays = spark.createDataFrame([
        (dt.datetime(2024, 1, 1, 1), "s", "card", "succeeded", Decimal("10.00")),
        (dt.datetime(2024, 1, 1, 2), "s", "card", "refunded", Decimal("2.50")),
        (dt.datetime(2024, 1, 1, 3), "s", "ach", "succeeded", Decimal("1.00")),
    ], "payment_timestamp timestamp_ntz, service_description string, payment_method string, status string, "
       "amount_dollars decimal(18,2)")
    rows = {r.payment_method: r for r in marts.mart_revenue(pays).collect()}
    assert rows["card"].revenue_dollars == Decimal("12.50")
    assert rows["card"].net_revenue_dollars == Decimal("10.00")
    assert rows["card"].avg_ticket_dollars == Decimal("6.25")
    assert rows["ach"].refund_dollars == Decimal("0.00") and rows["ach"].refund_count == 0
