"""Property checks: exact rounding against Python's Decimal, and a hot key
holding a third of the rows does not change results."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions.numeric import half_up_div
from ledgerline.operators import joins, marts

CASES = st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**9)), min_size=1, max_size=200)


@settings(max_examples=5, deadline=None)
@given(CASES, st.integers(0, 3))
def test_half_up_div_matches_decimal(spark, cases, digits):
    df = spark.createDataFrame(cases, "n long, d long")
    got = [r.q for r in df.select(half_up_div(F.col("n"), F.col("d"), digits).alias("q")).collect()]
    exp = [(Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)
           if abs(Decimal(n) / Decimal(d)) < Decimal(10) ** 20 else None for n, d in cases]
    # Decimal division above keeps 28 significant digits, enough for these ranges
    assert got == exp


def test_hot_call_id_is_counted_in_full(spark):
    t = dt.datetime(2024, 1, 1, 9)
    calls = spark.createDataFrame(
        [(str(i), t + dt.timedelta(hours=i % 30), "booked", 10, Decimal("0.50")) for i in range(300)],
        "call_id string, call_timestamp timestamp_ntz, outcome string, duration_seconds int, "
        "sentiment_score decimal(3,2)")
    # call "0" owns a third of all jobs
    jobs = spark.createDataFrame(
        [(f"j{i}", "0" if i < 150 else str(i % 300), "completed" if i % 2 else "cancelled") for i in range(450)],
        "job_id string, related_call_id string, job_status string")
    fused = marts.mart_call_funnel(calls, jobs).agg(
        F.sum("total_jobs"), F.sum("completed_jobs"), F.sum("cancelled_jobs")).first()
    assert tuple(fused) == (450, 225, 225)
    ref = joins.jobs_by_call_day(calls, jobs).agg(F.sum("total_jobs")).first()[0]
    assert ref == 450
    m = {r.reason: r.failures for r in joins.call_job_mismatches(calls, jobs).collect()}
    assert m["call_with_several_jobs"] == 1 and m["job_without_booked_call"] == 0  # only call "0"


def test_consistency_matches_brute_force(spark):
    """NULL call ids, unbooked calls and repeated booked ids, against a
    Python count of the three reasons."""
    t = dt.datetime(2024, 1, 1, 9)
    outcomes = ["booked", "missed", "booked", "qualified"]
    calls_rows = [(str(i), t, outcomes[i % 4], 10, Decimal("0.50")) for i in range(40)]
    calls_rows += [("2", t, "booked", 10, Decimal("0.50"))]  # booked id seen twice
    jobs_rows = [(f"j{i}", None if i % 9 == 0 else str(i % 50), "completed") for i in range(60)]
    calls = spark.createDataFrame(
        calls_rows, "call_id string, call_timestamp timestamp_ntz, outcome string, "
        "duration_seconds int, sentiment_score decimal(3,2)")
    jobs = spark.createDataFrame(jobs_rows, "job_id string, related_call_id string, job_status string")

    booked = [c[0] for c in calls_rows if c[2] == "booked"]
    job_ids = [j[1] for j in jobs_rows]
    keyed = [j for j in job_ids if j is not None]
    exp = {
        "booked_call_without_job": sum(1 for c in booked if c not in keyed),
        "job_without_booked_call": sum(1 for j in job_ids if j is None or j not in booked),
        "call_with_several_jobs": sum(1 for j in set(keyed) if keyed.count(j) > 1),
    }
    got = {r.reason: r.failures for r in joins.call_job_mismatches(calls, jobs).collect()}
    assert got == exp and all(v > 0 for v in exp.values())
