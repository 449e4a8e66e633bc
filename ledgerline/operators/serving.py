"""Serving queries over the marts (QRY-1..19).

Each takes mart DataFrames (plus optional filters) and returns a DataFrame.
Global summaries are single-stage aggregates; values that combine two global
aggregates use scalar subqueries (one value, evaluated once) rather than joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import avg_half_up, half_up_div, pct, to_units
from ledgerline.operators.filters import between_dates, where_category


def _avg2(c: str):
    """round(avg(c), 2) of a DECIMAL(.., 2) column, exact."""
    return avg_half_up(F.sum(c), F.count(c), 2, scale=2)


# -- API endpoints ---------------------------------------------------------

def call_funnel_daily(funnel: DataFrame) -> DataFrame:
    """QRY-1: the whole funnel mart by date."""
    return funnel.orderBy("call_date")


def call_funnel_summary(funnel: DataFrame) -> DataFrame:
    """QRY-2: grand totals, booking / escalation %, mean of daily sentiment."""
    return funnel.agg(
        F.sum("total_calls").alias("total_calls"),
        F.sum("qualified").alias("total_qualified"),
        F.sum("booked").alias("total_booked"),
        F.sum("escalated").alias("total_escalated"),
        F.sum("missed").alias("total_missed"),
        F.sum("completed_jobs").alias("total_completed"),
        pct(F.sum("booked"), F.sum("total_calls")).alias("booking_rate_pct"),
        pct(F.sum("escalated"), F.sum("total_calls")).alias("escalation_rate_pct"),
        _avg2("avg_sentiment").alias("avg_sentiment"),
    )


def revenue_daily(revenue: DataFrame) -> DataFrame:
    """QRY-3: per day gross, net and transactions."""
    return revenue.groupBy("payment_date").agg(
        F.sum("revenue_dollars").alias("revenue"),
        F.sum("net_revenue_dollars").alias("net_revenue"),
        F.sum("transaction_count").alias("transactions"),
    ).orderBy("payment_date")


def jobs_summary(jobs: DataFrame) -> DataFrame:
    """QRY-4: job grand totals."""
    return jobs.agg(
        F.sum("total_jobs").alias("total_jobs"),
        F.sum("completed").alias("total_completed"),
        F.sum("cancelled").alias("total_cancelled"),
        F.sum("scheduled").alias("total_scheduled"),
        pct(F.sum("completed"), F.sum("total_jobs")).alias("completion_rate_pct"),
        F.sum("total_completed_value").alias("total_completed_value"),
    )


def revenue_by_service(revenue: DataFrame) -> DataFrame:
    """QRY-5: per service gross, transactions, unweighted mean ticket."""
    return revenue.groupBy("service_description").agg(
        F.sum("revenue_dollars").alias("revenue"),
        F.sum("transaction_count").alias("transactions"),
        _avg2("avg_ticket_dollars").alias("avg_ticket"),
    ).orderBy(F.col("revenue").desc())


# -- parameterised tools ---------------------------------------------------

def revenue_summary(revenue: DataFrame, date_from=None, date_to=None,
                    group_by: str | None = None) -> DataFrame:
    """QRY-6/7/8: revenue totals over an inclusive date range.

    ``group_by='service'`` (QRY-7), ``'date'`` (QRY-8), anything else one row
    (QRY-6).
    """
    r = between_dates(revenue, "payment_date", date_from, date_to)
    if group_by == "service":
        return r.groupBy("service_description").agg(
            F.sum("transaction_count").alias("transaction_count"),
            F.sum("revenue_dollars").alias("revenue_dollars"),
            F.sum("net_revenue_dollars").alias("net_revenue_dollars"),
            _avg2("avg_ticket_dollars").alias("avg_ticket_dollars"),
            F.sum("refund_count").alias("refund_count"),
        ).orderBy(F.col("revenue_dollars").desc())
    if group_by == "date":
        return r.groupBy("payment_date").agg(
            F.sum("transaction_count").alias("transaction_count"),
            F.sum("revenue_dollars").alias("revenue_dollars"),
            F.sum("net_revenue_dollars").alias("net_revenue_dollars"),
            F.sum("refund_count").alias("refund_count"),
        ).orderBy("payment_date")
    return r.agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("revenue_dollars").alias("revenue_dollars"),
        F.sum("net_revenue_dollars").alias("net_revenue_dollars"),
        _avg2("avg_ticket_dollars").alias("avg_ticket_dollars"),
        F.sum("refund_count").alias("refund_count"),
        F.sum("refund_dollars").alias("refund_dollars"),
    )


def call_funnel_range(funnel: DataFrame, date_from=None, date_to=None) -> DataFrame:
    """QRY-9: one row of funnel totals over an inclusive date range."""
    f = between_dates(funnel, "call_date", date_from, date_to)
    return f.agg(
        F.sum("total_calls").alias("total_calls"),
        F.sum("booked").alias("booked"),
        F.sum("qualified").alias("qualified"),
        F.sum("escalated").alias("escalated"),
        F.sum("missed").alias("missed"),
        F.sum("resolved").alias("resolved"),
        pct(F.sum("booked"), F.sum("total_calls")).alias("booking_rate_pct"),
        pct(F.sum("escalated"), F.sum("total_calls")).alias("escalation_rate_pct"),
        _avg2("avg_sentiment").alias("avg_sentiment"),
        F.sum("total_jobs").alias("total_jobs"),
        F.sum("completed_jobs").alias("completed_jobs"),
        F.sum("cancelled_jobs").alias("cancelled_jobs"),
    )


def job_completion(jobs: DataFrame, service_category: str | None = None) -> DataFrame:
    """QRY-10: category rows, optional category filter, by value (NULLs first)."""
    j = where_category(jobs, "service_category", service_category)
    return j.select(
        "service_category", "total_jobs", "completed", "scheduled", "cancelled",
        "completion_rate_pct", "avg_completed_value", "total_completed_value",
    ).orderBy(F.col("total_completed_value").desc_nulls_first())


# -- saved BI questions ----------------------------------------------------

def bi_call_funnel(funnel: DataFrame) -> DataFrame:
    """QRY-11."""
    return funnel.select("call_date", "total_calls", "booked", "qualified", "escalated",
                         "missed", "completed_jobs").orderBy("call_date")


def bi_revenue(revenue: DataFrame) -> DataFrame:
    """QRY-12."""
    return revenue.groupBy("payment_date").agg(
        F.sum("revenue_dollars").alias("revenue"),
        F.sum("net_revenue_dollars").alias("net_revenue"),
    ).orderBy("payment_date")


def top_service(revenue: DataFrame, k: int = 1) -> DataFrame:
    """QRY-13: top-k services by gross (the limit is the feature)."""
    by = revenue.groupBy("service_description").agg(F.sum("revenue_dollars").alias("revenue"))
    return by.orderBy(F.col("revenue").desc(), F.col("service_description")).limit(k)


# -- dashboard reductions ---------------------------------------------------

def hero_totals(funnel: DataFrame, revenue: DataFrame) -> DataFrame:
    """QRY-14: total gross over all days plus the headline funnel numbers."""
    gross = revenue.agg(F.coalesce(F.sum("revenue_dollars"), F.lit(0)).alias("g")).scalar()
    return funnel.agg(
        F.sum("total_calls").alias("total_calls"),
        F.sum("booked").alias("total_booked"),
        F.coalesce(F.sum("completed_jobs"), F.lit(0)).alias("total_completed"),
        _avg2("avg_sentiment").alias("avg_sentiment"),
    ).select(gross.alias("total_revenue"), "*")


def miss_rate_overall(funnel: DataFrame) -> DataFrame:
    """QRY-15: miss rate (0 without calls) and the booking bar capped at 100."""
    s = call_funnel_summary(funnel)
    return s.select(
        F.coalesce(pct(F.col("total_missed"), F.col("total_calls")),
                   F.lit(0).cast("decimal(38,1)")).alias("miss_rate_pct"),
        F.least(F.coalesce(F.col("booking_rate_pct"), F.lit(0).cast("decimal(38,1)")),
                F.lit(100).cast("decimal(38,1)")).alias("booking_bar_pct"),
    )


def service_revenue_share(revenue: DataFrame) -> DataFrame:
    """QRY-16: each service's gross as a whole-number % of the largest one."""
    by = revenue_by_service(revenue)
    top = by.agg(F.max("revenue").alias("m")).scalar()
    return by.select(
        "service_description", "revenue",
        half_up_div(to_units(F.col("revenue"), 2) * F.lit(100), to_units(top, 2), 0).alias("share_pct"),
    )


FUNNEL_SERIES = ["booked", "qualified", "escalated", "missed"]


def funnel_chart_series(funnel: DataFrame) -> DataFrame:
    """QRY-17: daily outcome counts as stacked series with an MM-dd label."""
    long = funnel.select("call_date", *FUNNEL_SERIES).unpivot(
        ["call_date"], FUNNEL_SERIES, "series", "value")
    return long.select(
        "call_date", F.date_format("call_date", "MM-dd").alias("label"), "series", "value",
    ).orderBy("call_date", "series")


def revenue_chart_series(revenue: DataFrame) -> DataFrame:
    """QRY-18: MM-dd label + daily gross."""
    d = revenue_daily(revenue)
    return d.select("payment_date", F.date_format("payment_date", "MM-dd").alias("label"),
                    "revenue").orderBy("payment_date")


def revenue_per_completed_job(jobs: DataFrame) -> DataFrame:
    """QRY-19: completed-job value / completed count (the only allowed basis)."""
    return jobs.select(
        "service_category", "completed", "total_completed_value",
        half_up_div(to_units(F.col("total_completed_value"), 2), F.col("completed"), 2, 2)
        .alias("revenue_per_completed_job"),
    )
