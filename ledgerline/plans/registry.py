"""Registered queries: one Spark callable (spark, sf_dir) -> DataFrame per
inventory key, each next to its DuckDB oracle statement when SQL can express it.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.wire import MONTH, to_wire
from ledgerline.operators import joins, marts, serving
from ledgerline.operators.filters import between_dates, where_category
from ledgerline.plans import oracle as O
from ledgerline.plans.oracle import b, base, d, dbl, hu, tsf, with_
from ledgerline.plans.pipeline import layers as build_layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


_DEFINITIONS: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def layers(spark, sf, damaged=False):
    """Layer definitions of one input, shared by the queries of a session.

    Only the DataFrame definitions are shared (building them is driver work);
    every query still reads and computes everything from the tables.
    """
    per = _DEFINITIONS.setdefault(spark, {})
    key = (_input(spark, sf), damaged)
    if key not in per:
        per[key] = build_layers(spark, sf, damaged=damaged)
    return per[key]


def _marts(spark, sf):
    return layers(spark, sf).marts


_WRITTEN: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def _input(spark, sf) -> str:
    """The input as it is now: its path with names, sizes and times of the source files, so that tables
    written from an older state of it are not taken for this one."""
    from ledgerline.sources.lake import _fs

    parts = []
    for table in ("events", "lineitem", "orders", "part"):
        fs, path = _fs(spark, f"{sf.rstrip('/')}/{table}.parquet")
        if fs.exists(path):
            files = fs.listStatus(path)  # a file lists itself
            parts += [f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in files]
    return "|".join([sf.rstrip("/"), *parts])


def _written(spark, sf, what, build):
    """A table written once per session and state of the input below the shared folder, for queries that read it."""
    per = _WRITTEN.setdefault(spark, {})
    key = (_input(spark, sf), what)
    if key not in per:
        per[key] = build()
    return per[key]


def _served(spark, sf, name):
    """A mart as serving queries read it: the written table, dated marts in month folders."""
    return _written(spark, sf, name, lambda: marts.write_served(_marts(spark, sf)[name], name))


def _raw_written(spark, sf, damaged=False):
    """Raw tables written once; counts, load times and tests read these."""
    from ledgerline.plans.pipeline import materialize

    return _written(spark, sf, ("raw", damaged), lambda: materialize(spark, layers(spark, sf, damaged).raw))


# Parameters of the parameterised tools used by the registered queries.
REVENUE_FROM, REVENUE_TO = "1998-01-01", "1998-12-31"
FUNNEL_FROM, FUNNEL_TO = "2024-01-08", "2024-01-14"
CATEGORY = "boiler service"

# ---------------------------------------------------------------------------
# staging (PRJ-1..3)
# ---------------------------------------------------------------------------


@register("stg_calls", with_(base(()), (
    "SELECT call_id, " + tsf("call_timestamp") + " AS call_timestamp, caller_name, caller_phone, urgency, topic, "
    "outcome, duration_seconds, CAST(sentiment_score AS DOUBLE) AS sentiment_score, agent_id FROM stg_calls")))
def q_stg_calls(spark, sf):
    return to_wire(layers(spark, sf).staging["calls"])


@register("stg_payments", with_(base(()), (
    "SELECT payment_id, " + tsf("payment_timestamp") + " AS payment_timestamp, amount_cents, "
    + dbl("amount_cents", 2) + " AS amount_dollars, currency, status, payment_method, customer_email, "
    "service_description, metadata_source FROM stg_payments")))
def q_stg_payments(spark, sf):
    return to_wire(layers(spark, sf).staging["payments"])


@register("stg_jobs", with_(base(()), (
    "SELECT job_id, related_call_id, job_status, service_category, " + dbl("job_value_x100", 2)
    + " AS job_value, technician, " + tsf("scheduled_at") + " AS scheduled_at, " + tsf("completed_at")
    + " AS completed_at FROM stg_jobs")))
def q_stg_jobs(spark, sf):
    return to_wire(layers(spark, sf).staging["jobs"])


# ---------------------------------------------------------------------------
# joins and marts (JON-1..3, AGG-1..5)
# ---------------------------------------------------------------------------


@register("calls_jobs_daily", with_(base(("funnel",)), (
    f"SELECT {d('call_date')} AS call_date, total_jobs, completed_jobs, cancelled_jobs FROM mart_call_funnel")))
def q_calls_jobs_daily(spark, sf):
    stg = layers(spark, sf).staging
    return to_wire(joins.jobs_by_call_day(stg["calls"], stg["jobs"]))


@register("call_funnel_counts", with_(base(("funnel",)), (
    f"SELECT {d('call_date')} AS call_date, total_calls, qualified, booked, escalated, missed, resolved, "
    f"{dbl('avg_duration_x10', 1)} AS avg_duration_seconds, "
    f"{dbl('avg_sentiment_x100', 2)} AS avg_sentiment FROM mart_call_funnel")))
def q_call_funnel_counts(spark, sf):
    return to_wire(marts.call_funnel_counts(layers(spark, sf).staging["calls"]))


@register("funnel_with_jobs", with_(base(("funnel",)), (
    f"SELECT {d('call_date')} AS call_date, total_calls, qualified, booked, escalated, missed, resolved, "
    f"{dbl('avg_duration_x10', 1)} AS avg_duration_seconds, {dbl('avg_sentiment_x100', 2)} AS avg_sentiment, "
    "total_jobs, completed_jobs, cancelled_jobs FROM mart_call_funnel")))
def q_funnel_with_jobs(spark, sf):
    stg = layers(spark, sf).staging
    daily = marts.call_funnel_counts(stg["calls"])
    return to_wire(joins.with_jobs(daily, joins.jobs_by_call_day(stg["calls"], stg["jobs"])))


@register("mart_call_funnel", with_(base(("funnel",)), f"SELECT {O.FUNNEL_WIRE} FROM mart_call_funnel"))
def q_mart_call_funnel(spark, sf):
    return to_wire(marts.ordered_mart(_marts(spark, sf)["mart_call_funnel"], "mart_call_funnel"))


@register("mart_revenue", with_(base(("revenue",)), f"SELECT {O.REVENUE_WIRE} FROM mart_revenue"))
def q_mart_revenue(spark, sf):
    return to_wire(marts.ordered_mart(_marts(spark, sf)["mart_revenue"], "mart_revenue"))


@register("mart_jobs", with_(base(("jobs",)), f"SELECT {O.JOBS_WIRE} FROM mart_jobs"))
def q_mart_jobs(spark, sf):
    return to_wire(marts.ordered_mart(_marts(spark, sf)["mart_jobs"], "mart_jobs"))


@register("pipeline_rows", with_(base(()), (
    "SELECT 'calls' AS source, count(*) AS \"rows\" FROM raw_calls UNION ALL "
    "SELECT 'payments', count(*) FROM raw_payments UNION ALL SELECT 'jobs', count(*) FROM raw_jobs")))
def q_pipeline_rows(spark, sf):
    return marts.row_counts(_raw_written(spark, sf))


@register("call_job_consistency", with_(base((), damaged=True), (
    "SELECT 'booked_call_without_job' AS reason, count(*) AS failures FROM stg_calls c "
    "WHERE outcome = 'booked' AND NOT EXISTS (SELECT 1 FROM stg_jobs j WHERE j.related_call_id = c.call_id) "
    "UNION ALL SELECT 'job_without_booked_call', count(*) FROM stg_jobs j WHERE NOT EXISTS "
    "(SELECT 1 FROM stg_calls c WHERE c.outcome = 'booked' AND c.call_id = j.related_call_id) "
    "UNION ALL SELECT 'call_with_several_jobs', count(*) FROM (SELECT related_call_id FROM stg_jobs "
    "WHERE related_call_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")))
def q_call_job_consistency(spark, sf):
    stg = layers(spark, sf, damaged=True).staging
    return joins.call_job_mismatches(stg["calls"], stg["jobs"])


# ---------------------------------------------------------------------------
# filters (FLT-1, FLT-2)
# ---------------------------------------------------------------------------


@register("date_range", with_(base(("revenue",)), (
    f"SELECT {O.REVENUE_WIRE} FROM mart_revenue WHERE payment_date >= DATE '{REVENUE_FROM}' "
    f"AND payment_date <= DATE '{REVENUE_TO}'")))
def q_date_range(spark, sf):
    return to_wire(between_dates(_served(spark, sf, "mart_revenue"), "payment_date", REVENUE_FROM, REVENUE_TO))


@register("category_eq", with_(base(("jobs",)), (
    f"SELECT {O.JOBS_WIRE} FROM mart_jobs WHERE service_category = '{CATEGORY}'")))
def q_category_eq(spark, sf):
    return to_wire(where_category(_served(spark, sf, "mart_jobs"), "service_category", CATEGORY))


# ---------------------------------------------------------------------------
# serving (QRY-1..19)
# ---------------------------------------------------------------------------

_SUM_SENT = "sum(avg_sentiment_x100)"
_N_SENT = "count(avg_sentiment_x100)"


@register("call_funnel_daily", with_(base(("funnel",)), f"SELECT {O.FUNNEL_WIRE} FROM mart_call_funnel"))
def q_call_funnel_daily(spark, sf):
    return to_wire(serving.call_funnel_daily(_served(spark, sf, "mart_call_funnel")))


@register("call_funnel_summary", with_(base(("funnel",)), (
    f"SELECT {b('sum(total_calls)')} AS total_calls, {b('sum(qualified)')} AS total_qualified, "
    f"{b('sum(booked)')} AS total_booked, {b('sum(escalated)')} AS total_escalated, "
    f"{b('sum(missed)')} AS total_missed, {b('sum(completed_jobs)')} AS total_completed, "
    f"{dbl(hu('100 * sum(booked)', 'sum(total_calls)', 1), 1)} AS booking_rate_pct, "
    f"{dbl(hu('100 * sum(escalated)', 'sum(total_calls)', 1), 1)} AS escalation_rate_pct, "
    f"{dbl(hu(_SUM_SENT, _N_SENT, 2, 2), 2)} AS avg_sentiment FROM mart_call_funnel")))
def q_call_funnel_summary(spark, sf):
    return to_wire(serving.call_funnel_summary(_served(spark, sf, "mart_call_funnel")))


@register("revenue_daily", with_(base(("revenue",)), (
    f"SELECT {d('payment_date')} AS payment_date, {dbl('sum(revenue_cents)', 2)} AS revenue, "
    f"{dbl('sum(net_cents)', 2)} AS net_revenue, {b('sum(transaction_count)')} AS transactions "
    "FROM mart_revenue GROUP BY payment_date")))
def q_revenue_daily(spark, sf):
    return to_wire(serving.revenue_daily(_served(spark, sf, "mart_revenue")))


@register("jobs_summary", with_(base(("jobs",)), (
    f"SELECT {b('sum(total_jobs)')} AS total_jobs, {b('sum(completed)')} AS total_completed, "
    f"{b('sum(cancelled)')} AS total_cancelled, {b('sum(scheduled)')} AS total_scheduled, "
    f"{dbl(hu('100 * sum(completed)', 'sum(total_jobs)', 1), 1)} AS completion_rate_pct, "
    f"{dbl('sum(total_completed_cents)', 2)} AS total_completed_value FROM mart_jobs")))
def q_jobs_summary(spark, sf):
    return to_wire(serving.jobs_summary(_served(spark, sf, "mart_jobs")))


_AVG_TICKET = dbl(hu("sum(avg_ticket_cents)", "count(avg_ticket_cents)", 2, 2), 2)


@register("revenue_by_service", with_(base(("revenue",)), (
    f"SELECT service_description, {dbl('sum(revenue_cents)', 2)} AS revenue, "
    f"{b('sum(transaction_count)')} AS transactions, {_AVG_TICKET} AS avg_ticket "
    "FROM mart_revenue GROUP BY service_description")))
def q_revenue_by_service(spark, sf):
    return to_wire(serving.revenue_by_service(_served(spark, sf, "mart_revenue")))


_REV_WHERE = f"WHERE payment_date >= DATE '{REVENUE_FROM}' AND payment_date <= DATE '{REVENUE_TO}'"


@register("revenue_summary_total", with_(base(("revenue",)), (
    f"SELECT {b('sum(transaction_count)')} AS transaction_count, {dbl('sum(revenue_cents)', 2)} AS revenue_dollars, "
    f"{dbl('sum(net_cents)', 2)} AS net_revenue_dollars, {_AVG_TICKET} AS avg_ticket_dollars, "
    f"{b('sum(refund_count)')} AS refund_count, {dbl('sum(refund_cents)', 2)} AS refund_dollars "
    f"FROM mart_revenue {_REV_WHERE}")))
def q_revenue_summary_total(spark, sf):
    return to_wire(serving.revenue_summary(_served(spark, sf, "mart_revenue"), REVENUE_FROM, REVENUE_TO))


@register("revenue_summary_by_service", with_(base(("revenue",)), (
    f"SELECT service_description, {b('sum(transaction_count)')} AS transaction_count, "
    f"{dbl('sum(revenue_cents)', 2)} AS revenue_dollars, {dbl('sum(net_cents)', 2)} AS net_revenue_dollars, "
    f"{_AVG_TICKET} AS avg_ticket_dollars, {b('sum(refund_count)')} AS refund_count "
    f"FROM mart_revenue {_REV_WHERE} GROUP BY service_description")))
def q_revenue_summary_by_service(spark, sf):
    return to_wire(serving.revenue_summary(_served(spark, sf, "mart_revenue"), REVENUE_FROM, REVENUE_TO,
                                           group_by="service"))


@register("revenue_summary_by_date", with_(base(("revenue",)), (
    f"SELECT {d('payment_date')} AS payment_date, {b('sum(transaction_count)')} AS transaction_count, "
    f"{dbl('sum(revenue_cents)', 2)} AS revenue_dollars, {dbl('sum(net_cents)', 2)} AS net_revenue_dollars, "
    f"{b('sum(refund_count)')} AS refund_count FROM mart_revenue {_REV_WHERE} GROUP BY payment_date")))
def q_revenue_summary_by_date(spark, sf):
    return to_wire(serving.revenue_summary(_served(spark, sf, "mart_revenue"), REVENUE_FROM, REVENUE_TO,
                                           group_by="date"))


@register("call_funnel_range", with_(base(("funnel",)), (
    f"SELECT {b('sum(total_calls)')} AS total_calls, {b('sum(booked)')} AS booked, "
    f"{b('sum(qualified)')} AS qualified, {b('sum(escalated)')} AS escalated, {b('sum(missed)')} AS missed, "
    f"{b('sum(resolved)')} AS resolved, "
    f"{dbl(hu('100 * sum(booked)', 'sum(total_calls)', 1), 1)} AS booking_rate_pct, "
    f"{dbl(hu('100 * sum(escalated)', 'sum(total_calls)', 1), 1)} AS escalation_rate_pct, "
    f"{dbl(hu(_SUM_SENT, _N_SENT, 2, 2), 2)} AS avg_sentiment, {b('sum(total_jobs)')} AS total_jobs, "
    f"{b('sum(completed_jobs)')} AS completed_jobs, {b('sum(cancelled_jobs)')} AS cancelled_jobs "
    f"FROM mart_call_funnel WHERE call_date >= DATE '{FUNNEL_FROM}' AND call_date <= DATE '{FUNNEL_TO}'")))
def q_call_funnel_range(spark, sf):
    return to_wire(serving.call_funnel_range(_served(spark, sf, "mart_call_funnel"), FUNNEL_FROM, FUNNEL_TO))


@register("job_completion", with_(base(("jobs",)), f"SELECT {O.JOBS_WIRE} FROM mart_jobs"))
def q_job_completion(spark, sf):
    return to_wire(serving.job_completion(_served(spark, sf, "mart_jobs")))


@register("bi_call_funnel", with_(base(("funnel",)), (
    f"SELECT {d('call_date')} AS call_date, total_calls, booked, qualified, escalated, missed, completed_jobs "
    "FROM mart_call_funnel")))
def q_bi_call_funnel(spark, sf):
    return to_wire(serving.bi_call_funnel(_served(spark, sf, "mart_call_funnel")))


@register("bi_revenue", with_(base(("revenue",)), (
    f"SELECT {d('payment_date')} AS payment_date, {dbl('sum(revenue_cents)', 2)} AS revenue, "
    f"{dbl('sum(net_cents)', 2)} AS net_revenue FROM mart_revenue GROUP BY payment_date")))
def q_bi_revenue(spark, sf):
    return to_wire(serving.bi_revenue(_served(spark, sf, "mart_revenue")))


@register("top_service", with_(base(("revenue",)), (
    f"SELECT service_description, {dbl('sum(revenue_cents)', 2)} AS revenue FROM mart_revenue "
    "GROUP BY service_description ORDER BY sum(revenue_cents) DESC, service_description LIMIT 1")))
def q_top_service(spark, sf):
    return to_wire(serving.top_service(_served(spark, sf, "mart_revenue"), 1))


@register("hero_totals", with_(base(("funnel", "revenue")), (
    f"SELECT (SELECT {dbl('coalesce(sum(revenue_cents), 0)', 2)} FROM mart_revenue) AS total_revenue, "
    f"{b('sum(total_calls)')} AS total_calls, {b('sum(booked)')} AS total_booked, "
    f"{b('coalesce(sum(completed_jobs), 0)')} AS total_completed, "
    f"{dbl(hu(_SUM_SENT, _N_SENT, 2, 2), 2)} AS avg_sentiment FROM mart_call_funnel")))
def q_hero_totals(spark, sf):
    m = {n: _served(spark, sf, n) for n in ("mart_call_funnel", "mart_revenue")}
    return to_wire(serving.hero_totals(m["mart_call_funnel"], m["mart_revenue"]))


_MISS = hu("100 * sum(missed)", "sum(total_calls)", 1)
_BOOK = hu("100 * sum(booked)", "sum(total_calls)", 1)


@register("miss_rate_overall", with_(base(("funnel",)), (
    f"SELECT {dbl(f'coalesce({_MISS}, 0)', 1)} AS miss_rate_pct, "
    f"{dbl(f'least(coalesce({_BOOK}, 0), 1000)', 1)} AS booking_bar_pct FROM mart_call_funnel")))
def q_miss_rate_overall(spark, sf):
    return to_wire(serving.miss_rate_overall(_served(spark, sf, "mart_call_funnel")))


@register("service_revenue_share", with_(base(("revenue",)) + [
    "bys AS (SELECT service_description, sum(revenue_cents) AS rev FROM mart_revenue GROUP BY 1)"], (
    f"SELECT service_description, {dbl('rev', 2)} AS revenue, "
    f"{dbl(hu('100 * rev', '(SELECT max(rev) FROM bys)', 0), 0)} AS share_pct FROM bys")))
def q_service_revenue_share(spark, sf):
    return to_wire(serving.service_revenue_share(_served(spark, sf, "mart_revenue")))


@register("funnel_chart_series", with_(base(("funnel",)), (
    "SELECT call_date, label, series, value FROM ("
    f"SELECT {d('call_date')} AS call_date, strftime(call_date, '%m-%d') AS label, booked, qualified, escalated, missed "
    "FROM mart_call_funnel) UNPIVOT (value FOR series IN (booked, qualified, escalated, missed))")))
def q_funnel_chart_series(spark, sf):
    return to_wire(serving.funnel_chart_series(_served(spark, sf, "mart_call_funnel")))


@register("revenue_chart_series", with_(base(("revenue",)), (
    f"SELECT {d('payment_date')} AS payment_date, strftime(payment_date, '%m-%d') AS label, "
    f"{dbl('sum(revenue_cents)', 2)} AS revenue FROM mart_revenue GROUP BY payment_date")))
def q_revenue_chart_series(spark, sf):
    return to_wire(serving.revenue_chart_series(_served(spark, sf, "mart_revenue")))


@register("revenue_per_completed_job", with_(base(("jobs",)), (
    f"SELECT service_category, completed, {dbl('total_completed_cents', 2)} AS total_completed_value, "
    f"{dbl(hu('total_completed_cents', 'completed', 2, 2), 2)} AS revenue_per_completed_job FROM mart_jobs")))
def q_revenue_per_completed_job(spark, sf):
    return to_wire(serving.revenue_per_completed_job(_served(spark, sf, "mart_jobs")))


# ---------------------------------------------------------------------------
# data quality (DQ-1..9)
# ---------------------------------------------------------------------------

from ledgerline.operators import metrics as M  # noqa: E402
from ledgerline.operators import quality as Q  # noqa: E402
from ledgerline.plans.pipeline import AS_OF, AS_OF_WARN  # noqa: E402


def _damaged_tables(spark, sf):
    from ledgerline.operators.staging import staging

    raw = _raw_written(spark, sf, damaged=True)
    stg = staging(raw)
    return Q.layer_tables(raw, stg, marts.build_marts(stg))


def _run_suite(spark, sf):
    from ledgerline.operators.staging import inline_views

    # staging tests run inside the raw scans (one scan per source)
    return Q.run_suite(_damaged_tables(spark, sf), Q.DEFAULT_SUITE, views=inline_views())


def _suite(spark, sf):
    """One row per declared test, computed once per session and input; gate, roll-up, alerts and metrics read it."""
    from ledgerline.session import scratch_path

    def build():
        results, path = _run_suite(spark, sf), scratch_path(spark, "suite")
        results.coalesce(1).write.parquet(path)
        return spark.read.schema(results.schema).parquet(path)

    return _written(spark, sf, "suite", build)


def _artifact_counts(spark, sf):
    """Counts read back from the run's result artifact, a JSON file written once."""
    from ledgerline.session import scratch_path

    def build():
        res, path = _suite(spark, sf), scratch_path(spark, "artifact")
        statuses = Q.artifact_statuses(res, Q.gate(res))
        statuses.agg(F.collect_list(F.struct("status")).alias("results"), F.lit(RUN_SECONDS).alias("elapsed_time")).write.json(path)
        return path

    return Q.status_counts(Q.read_run_results(spark, _written(spark, sf, "artifact", build)))


@register("dq_not_null", with_(base(()), (
    "SELECT 'completed_at' AS \"column\", 'not_null' AS test, count(*) AS failures "
    "FROM stg_jobs WHERE completed_at IS NULL")))
def q_dq_not_null(spark, sf):
    return Q.not_null(layers(spark, sf).staging["jobs"], "completed_at")


@register("dq_unique", with_(base((), damaged=True), (
    "SELECT 'payment_id' AS \"column\", 'unique' AS test, count(*) AS failures FROM "
    "(SELECT payment_id FROM raw_payments WHERE payment_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")))
def q_dq_unique(spark, sf):
    return Q.unique(layers(spark, sf, damaged=True).raw["payments"], "payment_id")


@register("dq_accepted_values", with_(base((), damaged=True), (
    "SELECT 'urgency' AS \"column\", 'accepted_values' AS test, "
    "count(DISTINCT urgency) FILTER (WHERE urgency NOT IN ('low', 'medium', 'high', 'critical')) AS failures "
    "FROM raw_calls")))
def q_dq_accepted_values(spark, sf):
    from ledgerline.schemas import URGENCY_VALUES

    return Q.accepted_values(layers(spark, sf, damaged=True).raw["calls"], "urgency", URGENCY_VALUES)


_ORACLE_TABLE = {"raw.calls": "raw_calls", "raw.payments": "raw_payments", "raw.jobs": "raw_jobs"}
_ORACLE_COLUMN = {("mart_revenue", "revenue_dollars"): "revenue_cents"}


def _suite_sql() -> str:
    parts = []
    for t in Q.DEFAULT_SUITE:
        tbl = _ORACLE_TABLE.get(t.model, t.model)
        col = '"' + _ORACLE_COLUMN.get((t.model, t.column), t.column) + '"'
        if t.test == "not_null":
            f = f"(SELECT count(*) FROM {tbl} WHERE {col} IS NULL)"
        elif t.test == "unique":
            f = f"(SELECT count(*) FROM (SELECT {col} FROM {tbl} WHERE {col} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
        else:
            vals = ", ".join(O.q(v) for v in t.values)
            f = f"(SELECT count(DISTINCT CAST({col} AS VARCHAR)) FROM {tbl} WHERE CAST({col} AS VARCHAR) NOT IN ({vals}))"
        parts.append(f"SELECT {O.q(t.layer)} AS layer, {O.q(t.model)} AS model, {O.q(t.column)} AS \"column\", "
                     f"{O.q(t.test)} AS test, {f} AS failures")
    return "suite AS (" + " UNION ALL ".join(parts) + ")"


def _gate_ctes() -> list[str]:
    edges = ", ".join(f"({O.q(p)}, {O.q(c)})" for p, c in Q.LINEAGE)
    models = ", ".join(f"({O.q(m)})" for m in Q.MODELS)
    return [
        _suite_sql(),
        "failed AS (SELECT model, max(failures) > 0 AS failed FROM suite GROUP BY model)",
        f"edges(parent, child) AS (VALUES {edges})",
        "anc AS (SELECT parent, child FROM edges UNION SELECT a.parent, b.child FROM edges a "
        "JOIN edges b ON a.child = b.parent)",
        "bad AS (SELECT DISTINCT anc.child AS model FROM anc JOIN failed f ON f.model = anc.parent AND f.failed)",
        f"models(model) AS (VALUES {models})",
        "gate AS (SELECT m.model, CASE WHEN b.model IS NOT NULL THEN 'skip' WHEN f.failed THEN 'fail' "
        "ELSE 'pass' END AS status FROM models m LEFT JOIN failed f ON f.model = m.model "
        "LEFT JOIN bad b ON b.model = m.model)",
        "art AS (SELECT CASE WHEN g.status = 'skip' THEN 'skip' WHEN s.failures > 0 THEN 'fail' ELSE 'pass' END "
        "AS status FROM suite s LEFT JOIN gate g ON g.model = s.model)",
        "statuses(ord, status) AS (VALUES " + ", ".join(
            f"({i}, {O.q(s)})" for i, s in enumerate(Q.RESULT_STATUSES)) + ")",
        "counts AS (SELECT st.status, CAST(count(art.status) AS BIGINT) AS n FROM statuses st "
        "LEFT JOIN art ON art.status = st.status GROUP BY st.status)",
    ]


@register("dq_suite", with_(base(damaged=True) + [_suite_sql()], (
    "SELECT layer, model, \"column\", test, CAST(failures AS BIGINT) AS failures, "
    "CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM suite")))
def q_dq_suite(spark, sf):
    return _run_suite(spark, sf)


@register("dq_gate", with_(base(damaged=True) + _gate_ctes(), "SELECT model, status FROM gate"))
def q_dq_gate(spark, sf):
    return Q.gate(_suite(spark, sf))


@register("dq_status_counts", with_(base(damaged=True) + _gate_ctes(), "SELECT status, n FROM counts"))
def q_dq_status_counts(spark, sf):
    return _artifact_counts(spark, sf)


def _freshness_ctes(as_of) -> list[str]:
    a = O.ts_lit(as_of)
    us = f"date_diff('microsecond', last_loaded, {a})"
    h0 = f"CAST(CAST(round_even({us} / 3600000000.0, 0) AS BIGINT) AS VARCHAR)"
    return [
        "last AS (SELECT 0 AS ord, 'calls' AS source, max(_loaded_at) AS last_loaded FROM raw_calls UNION ALL "
        "SELECT 1, 'payments', max(_loaded_at) FROM raw_payments UNION ALL "
        "SELECT 2, 'jobs', max(_loaded_at) FROM raw_jobs)",
        f"fresh AS (SELECT ord, source, last_loaded, {hu(us, '3600000000', 1)} AS age_x10, "
        f"CASE WHEN last_loaded IS NULL THEN 'error' WHEN {us} > {48 * 3600 * 10**6} THEN 'error' "
        f"WHEN {us} > {24 * 3600 * 10**6} THEN 'warn' ELSE 'fresh' END AS status, "
        f"CASE WHEN last_loaded IS NULL THEN source || ': no data loaded' "
        f"WHEN {us} > {48 * 3600 * 10**6} THEN source || ': stale (' || {h0} || 'h old, threshold is 48h)' "
        f"WHEN {us} > {24 * 3600 * 10**6} THEN source || ': data is ' || {h0} || 'h old (warn threshold is 24h)' "
        "END AS message FROM last)",
        "verdict AS (SELECT NOT bool_or(status = 'error') AS fresh, bool_or(status = 'warn') AS warn, "
        "CASE WHEN bool_or(status = 'error') THEN 'Cannot answer: data is stale. ' || "
        "string_agg(message, '; ' ORDER BY ord) || '. Please run the pipeline before querying.' "
        "WHEN bool_or(status = 'warn') THEN 'Note: ' || string_agg(message, '; ' ORDER BY ord) || "
        "'. Answers reflect data as of those times.' END AS message FROM fresh)",
    ]


@register("freshness_status", with_(O.raw_ctes() + _freshness_ctes(AS_OF), (
    f"SELECT source, {tsf('last_loaded')} AS last_loaded, {dbl('age_x10', 1)} AS age_hours, status, message "
    "FROM fresh")))
def q_freshness_status(spark, sf):
    return to_wire(Q.freshness(_raw_written(spark, sf), AS_OF).drop("ord"))


@register("freshness_verdict", with_(O.raw_ctes() + _freshness_ctes(AS_OF),
                                     "SELECT fresh, warn, message FROM verdict"))
def q_freshness_verdict(spark, sf):
    return Q.verdict(Q.freshness(_raw_written(spark, sf), AS_OF))


@register("gated_query", with_(base(("revenue",)) + _freshness_ctes(AS_OF_WARN), (
    f"SELECT {b('sum(transaction_count)')} AS transaction_count, {dbl('sum(revenue_cents)', 2)} AS revenue_dollars, "
    f"{dbl('sum(net_cents)', 2)} AS net_revenue_dollars, {_AVG_TICKET} AS avg_ticket_dollars, "
    f"{b('sum(refund_count)')} AS refund_count, {dbl('sum(refund_cents)', 2)} AS refund_dollars, "
    f"(SELECT message FROM verdict) AS caveat FROM mart_revenue {_REV_WHERE}")))
def q_gated_query(spark, sf):
    v = Q.verdict(Q.freshness(_raw_written(spark, sf), AS_OF_WARN))
    return Q.gated_frame(v, lambda: to_wire(serving.revenue_summary(
        _served(spark, sf, "mart_revenue"), REVENUE_FROM, REVENUE_TO)))


# ---------------------------------------------------------------------------
# pipeline and request metrics (OBS-1..10)
# ---------------------------------------------------------------------------

RUN_SECONDS = 42.0


@register("pipeline_metrics", with_(base(damaged=True) + _gate_ctes(), (
    f"SELECT {tsf(O.ts_lit(AS_OF))} AS ts, 'pipeline_run_duration_seconds' AS metric, '' AS label, "
    f"{RUN_SECONDS} AS value UNION ALL SELECT {tsf(O.ts_lit(AS_OF))}, 'pipeline_last_success_timestamp', '', "
    f"CAST(epoch({O.ts_lit(AS_OF)}) AS DOUBLE) UNION ALL "
    f"SELECT {tsf(O.ts_lit(AS_OF))}, 'pipeline_rows_loaded', 'calls', CAST(count(*) AS DOUBLE) FROM raw_calls UNION ALL "
    f"SELECT {tsf(O.ts_lit(AS_OF))}, 'pipeline_rows_loaded', 'payments', CAST(count(*) AS DOUBLE) FROM raw_payments UNION ALL "
    f"SELECT {tsf(O.ts_lit(AS_OF))}, 'pipeline_rows_loaded', 'jobs', CAST(count(*) AS DOUBLE) FROM raw_jobs UNION ALL "
    f"SELECT {tsf(O.ts_lit(AS_OF))}, 'pipeline_test_results', status, CAST(n AS DOUBLE) FROM counts")))
def q_pipeline_metrics(spark, sf):
    return to_wire(M.pipeline_metrics(marts.row_counts(_raw_written(spark, sf, damaged=True)), _artifact_counts(spark, sf),
                                      RUN_SECONDS, AS_OF))


@register("metric_last_value", with_(base(()) + [
    "samples AS (SELECT CAST(CAST(call_timestamp AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS ts, 'calls' AS label, "
    "CAST(count(*) AS DOUBLE) AS value FROM stg_calls GROUP BY 1 UNION ALL "
    "SELECT CAST(CAST(payment_timestamp AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY, 'payments', CAST(count(*) AS DOUBLE) "
    "FROM stg_payments GROUP BY 1 UNION ALL "
    "SELECT CAST(CAST(scheduled_at AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY, 'jobs', CAST(count(*) AS DOUBLE) "
    "FROM stg_jobs GROUP BY 1)"], (
    f"SELECT 'pipeline_rows_loaded' AS metric, label, {tsf('max(ts)')} AS ts, arg_max(value, ts) AS value "
    "FROM samples GROUP BY label")))
def q_metric_last_value(spark, sf):
    return to_wire(M.last_values(M.daily_load_samples(layers(spark, sf).staging)))


def _log(spark, sf):
    from ledgerline.sources.tables import read_table

    return M.request_log(read_table(spark, sf, "events"))


_LOG = ("log AS (SELECT ts, '/api/' || event_type AS endpoint, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END "
        "AS status, CASE WHEN event_id % 40 <> 0 THEN value END AS duration_ms FROM events)")


def _win(minutes: int) -> str:
    return f"time_bucket(INTERVAL '{minutes} minutes', ts)"


@register("request_rate", with_([_LOG], (
    f"SELECT {tsf(_win(1))} AS window_start, {tsf(_win(1) + ' + INTERVAL 1 MINUTE')} AS window_end, "
    f"count(*) AS requests, count(*) / 60 AS rps FROM log GROUP BY {_win(1)}")))
def q_request_rate(spark, sf):
    return to_wire(M.request_rate(_log(spark, sf)))


def _quantile_sql() -> list[str]:
    bounds = [float(x) for x in M.LATENCY_BOUNDS_MS]
    bidx = "CASE " + " ".join(f"WHEN duration_ms <= {x} THEN {i}" for i, x in enumerate(bounds)) + \
        f" ELSE {len(bounds)} END"
    his = "[" + ", ".join(str(x) for x in bounds) + ", NULL]"
    los = "[" + ", ".join(str(x) for x in bounds) + "]"
    sel = []
    for q_ in M.QUANTILES:
        rank = f"(CAST({q_} AS DOUBLE) * total)"
        interp = f"lo + (hi - lo) * (({rank} - prev_cum) / n)"
        sel.append(f"max(CASE WHEN prev_cum < {rank} AND cum >= {rank} THEN "
                   f"(CASE WHEN hi IS NULL THEN {bounds[-1]} ELSE {interp} END) END) AS p{int(round(q_ * 100))}")
    return [
        _LOG,
        f"bk AS (SELECT {_win(5)} AS w, {bidx} AS b, count(*) AS n FROM log WHERE duration_ms IS NOT NULL GROUP BY 1, 2)",
        "cum AS (SELECT w, b, n, sum(n) OVER (PARTITION BY w ORDER BY b ROWS UNBOUNDED PRECEDING) AS cum FROM bk)",
        f"rows_ AS (SELECT w, n, cum, cum - n AS prev_cum, "
        f"CASE WHEN b = 0 THEN 0.0 ELSE CAST(({los})[b] AS DOUBLE) END AS lo, "
        f"CAST(({his})[b + 1] AS DOUBLE) AS hi, max(cum) OVER (PARTITION BY w) AS total FROM cum)",
        f"quant AS (SELECT w, CAST(max(total) AS BIGINT) AS total, {', '.join(sel)} FROM rows_ GROUP BY w)",
    ]


@register("latency_quantiles", with_(_quantile_sql(), (
    f"SELECT {tsf('w')} AS window_start, {tsf('w + INTERVAL 5 MINUTE')} AS window_end, total, p50, p95, p99 "
    "FROM quant")))
def q_latency_quantiles(spark, sf):
    return to_wire(M.latency_quantiles(_log(spark, sf)))


def _band_sql(col: str, steps) -> str:
    expr = "'green'"
    for thr, colour in steps:
        expr = f"CASE WHEN {col} >= {thr} THEN '{colour}' ELSE {expr} END"
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE {expr} END"


@register("metric_banding", with_(_quantile_sql(), (
    f"SELECT {tsf('w')} AS window_start, {tsf('w + INTERVAL 5 MINUTE')} AS window_end, p95, "
    f"{_band_sql('p95', M.BANDS['latency_ms'])} AS band FROM quant")))
def q_metric_banding(spark, sf):
    qdf = M.latency_quantiles(_log(spark, sf)).select("window_start", "window_end", "p95")
    return to_wire(M.band(qdf, "p95", M.BANDS["latency_ms"]))


@register("error_ratio", with_([_LOG], (
    f"SELECT {tsf(_win(5))} AS window_start, {tsf(_win(5) + ' + INTERVAL 5 MINUTE')} AS window_end, "
    "count(*) FILTER (WHERE regexp_matches(CAST(status AS VARCHAR), '^5..$')) AS errors, count(*) AS requests, "
    "count(*) FILTER (WHERE regexp_matches(CAST(status AS VARCHAR), '^5..$')) / count(*) AS error_ratio "
    f"FROM log GROUP BY {_win(5)}")))
def q_error_ratio(spark, sf):
    return to_wire(M.error_ratio(_log(spark, sf)))


@register("requests_by_endpoint", with_([_LOG], (
    f"SELECT {tsf(_win(60))} AS window_start, {tsf(_win(60) + ' + INTERVAL 1 HOUR')} AS window_end, endpoint, "
    f"count(*) AS requests FROM log GROUP BY {_win(60)}, endpoint")))
def q_requests_by_endpoint(spark, sf):
    return to_wire(M.requests_by_endpoint(_log(spark, sf)))


def _breach_sql(as_of) -> list[str]:
    asu = int(as_of.replace(tzinfo=__import__("datetime").timezone.utc).timestamp()) * 10**6
    g, thr, fs = 60 * 10**6, 172800 * 10**6, 300
    return [
        "data_days AS (SELECT DISTINCT 'calls' AS pipeline, epoch(call_timestamp::DATE)::BIGINT // 86400 AS n FROM stg_calls UNION "
        "SELECT DISTINCT 'payments', epoch(payment_timestamp::DATE)::BIGINT // 86400 FROM stg_payments UNION "
        "SELECT DISTINCT 'jobs', epoch(scheduled_at::DATE)::BIGINT // 86400 FROM stg_jobs)",
        "arr AS (SELECT pipeline, (n * 86400 + n % 7 * 60) * 1000000 AS u FROM data_days "
        f"WHERE n % 2 = 0 AND n % 14 <> 0 AND (n * 86400 + n % 7 * 60) * 1000000 <= {asu})",
        "gaps AS (SELECT pipeline, u AS a, lead(u) OVER (PARTITION BY pipeline ORDER BY u) AS b FROM arr)",
        f"isl AS (SELECT pipeline, ((a + {thr}) // {g} + 1) * {g} AS t1, "
        f"CASE WHEN b IS NULL THEN {asu // g * g} ELSE ((b + {g - 1}) // {g} - 1) * {g} END AS t2 FROM gaps)",
        f"br AS (SELECT pipeline, t1, t2, (t2 - t1) // 1000000 AS held FROM isl WHERE t2 >= t1)",
    ]


@register("alert_freshness", with_(base(()) + _breach_sql(AS_OF), (
    f"SELECT pipeline, {tsf('make_timestamp(t1)')} AS start, {tsf('make_timestamp(t2)')} AS \"end\", "
    "CAST(held AS BIGINT) AS held_seconds, held >= 300 AS fired, "
    f"CASE WHEN held >= 300 THEN {tsf('make_timestamp(t1 + 300000000)')} END AS fired_at FROM br")))
def q_alert_freshness(spark, sf):
    arrivals = M.success_samples(layers(spark, sf).staging)
    return to_wire(M.freshness_breaches(arrivals, "pipeline", "t", AS_OF))


@register("alert_test_failure", with_(base(damaged=True) + _gate_ctes(), (
    "SELECT 'PipelineTestFailure' AS alert, status, n FROM counts WHERE status IN ('fail', 'error') AND n > 0")))
def q_alert_test_failure(spark, sf):
    return M.test_alerts(_artifact_counts(spark, sf))


@register("failed_test_total", with_(base(damaged=True) + _gate_ctes(), (
    "SELECT CAST(coalesce(sum(n) FILTER (WHERE regexp_matches(status, '^(fail|error)$')), 0) AS BIGINT) "
    "AS failed_tests FROM counts")))
def q_failed_test_total(spark, sf):
    return M.failed_tests(_artifact_counts(spark, sf))


# ---------------------------------------------------------------------------
# guarded ad-hoc SELECT (SQL-1..5)
# ---------------------------------------------------------------------------

from ledgerline.operators import guard as G  # noqa: E402


def _statements(spark, sf):
    from ledgerline.sources.tables import read_table

    return G.statements_from_events(read_table(spark, sf, "events"))


def _re(p: str) -> str:
    return O.q(p)


_STMT = ("stmt AS (SELECT event_id AS statement_id, ts, CASE "
         "WHEN event_type = 'purchase' THEN 'SELECT * FROM marts.mart_revenue LIMIT ' || "
         "CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) * 5 AS VARCHAR) "
         "WHEN event_type = 'signup' AND event_id % 4 = 0 THEN ' ' || chr(160) || chr(10) "
         "WHEN event_type = 'signup' THEN 'SELECT count(*) FROM raw.calls' "
         "WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'SELECT * FROM marts.mart_jobs WHERE 1 = 1 OR delete' "
         "WHEN event_type = 'error' THEN 'DROP TABLE marts.mart_revenue' "
         "WHEN event_type = 'click' AND event_id % 4 = 0 THEN 'SELECT * FROM mart_revenue' || chr(233) "
         "WHEN event_type = 'click' THEN '/* c */ SELECT * FROM marts.mart_jobs' ELSE 'SELECT 1; SELECT 2' END AS sql FROM events)")

_ALLOWED = "[" + ", ".join(O.q(t) for t in G.ALLOWED_TABLES) + "]"
_TRIM = _re(f"^{G.BLANK}+|{G.BLANK}+$")
_VET = [
    _STMT,
    f"s1 AS (SELECT *, regexp_replace(coalesce(sql, ''), {_TRIM}, '', 'g') AS stripped FROM stmt)",
    f"s2 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(stripped, {_re(G.RE_BLOCK_COMMENT)}, ' ', 'g'), "
    f"{_re(G.RE_LINE_COMMENT)}, ' ', 'g'), {_TRIM}, '', 'g') AS nc FROM s1)",
    f"s3 AS (SELECT *, upper(regexp_extract(nc, {_re(G.RE_FORBIDDEN)}, 1)) AS kw, "
    f"list_filter(regexp_extract_all(nc, {_re(G.RE_TABLE_REF)}, 1), "
    f"lambda x: NOT list_contains({_ALLOWED}, lower(x)))[1] AS bad_ref FROM s2)",
    "vetted AS (SELECT statement_id, ts, sql, CASE WHEN stripped = '' THEN 'Empty query' "
    "WHEN NOT starts_with(upper(nc), 'SELECT') THEN 'Only SELECT queries are allowed' "
    "WHEN contains(stripped, ';') THEN 'Multi-statement queries are not allowed' "
    "WHEN kw <> '' THEN 'Forbidden keyword: ' || kw "
    f"WHEN regexp_matches(stripped, {_re(G.RE_SCHEMA)}) THEN {O.q(G.MSG_SCHEMA)} "
    "WHEN bad_ref IS NOT NULL THEN 'Table not allowed: ' || bad_ref || '. Only marts tables are accessible.' "
    "ELSE '' END AS reason FROM s3)",
]


@register("vet_statements", with_(_VET, "SELECT statement_id, reason, reason = '' AS ok FROM vetted"))
def q_vet_statements(spark, sf):
    return G.vet(_statements(spark, sf), "sql").select("statement_id", "reason", "ok")


_CAP = (f"CASE WHEN regexp_extract(sql, {_re(G.RE_LIMIT)}, 1) = '' THEN "
        "regexp_replace(regexp_replace(sql, '\\s+$', ''), ';+$', '') || ' LIMIT 100' "
        f"WHEN length(regexp_extract(sql, {_re(G.RE_LIMIT)}, 1)) > 38 OR "
        f"TRY_CAST(regexp_extract(sql, {_re(G.RE_LIMIT)}, 1) AS DECIMAL(38,0)) > 100 "
        f"THEN regexp_replace(sql, {_re(G.RE_FIRST_LIMIT)}, '\\1100') ELSE sql END")


@register("cap_limits", with_([_STMT], f"SELECT statement_id, {_CAP} AS capped_sql FROM stmt"))
def q_cap_limits(spark, sf):
    return G.cap(_statements(spark, sf), "sql").select("statement_id", "capped_sql")


_OUTSIDE = ["default", "marts", "spark_catalog"]
_KNOWN = ", ".join(O.q(w) for w in [*G.BRACKET_WORDS, *G.FUNCTIONS])
_PROBES = [
    "probe AS (SELECT event_id AS statement_id, json_extract_string(props, '$.k') AS k, event_type AS et, event_id % 4 = 0 AS turn FROM events)",
    "said AS (SELECT statement_id, CASE WHEN et = 'purchase' THEN 'SELECT sum(revenue_dollars) FROM marts.mart_revenue WHERE transaction_count > ' || k "
    "WHEN et = 'signup' AND turn THEN 'SELECT aggregate(sequence(1, ' || k || '), 0, (a, x) -> a + x) FROM mart_jobs' "
    "WHEN et = 'signup' THEN 'SELECT ''reflect('' || service_category, \"default.b(\" FROM mart_jobs -- range(' || k || ')' "
    "WHEN et = 'error' AND turn THEN 'SELECT * FROM mart_jobs, `default` . t' || k "
    "WHEN et = 'error' THEN 'SELECT r''\\'', reflect(''x'') FROM mart_jobs' "
    "WHEN et = 'click' AND turn THEN 'SELECT `reflect` /* ( */ (''java.lang.System'', ''nanoTime'') FROM mart_jobs' "
    "WHEN et = 'click' THEN 'SELECT a.total_jobs FROM marts.mart_jobs a CROSS JOIN marts.mart_revenue' "
    "ELSE 'SELECT current_user, ' || k || ' FROM mart_jobs' END AS sql FROM probe)",
    # in these statements the schema stands before a mart wherever it stands
    f"shown AS (SELECT *, regexp_replace(replace(sql, 'marts.mart_', 'mart_'), {_re(G.RE_QUOTED)}, '\\1\\2\\3 ', 'g') AS t FROM said)",
    f"calls AS (SELECT *, list_filter(list_transform(regexp_extract_all(t, {_re(G.RE_CALL)}, 1), lambda c: lower(replace(c, '`', ''))), "
    f"lambda c: NOT list_contains([{_KNOWN}], c))[1] AS call FROM shown)",
]


@register("refuse_statements", with_(_PROBES, (
    "SELECT statement_id, sql, CASE WHEN regexp_matches(sql, '(?i)(^|[^a-z0-9_])r[''\"]') THEN 'Raw texts are not allowed' "
    "WHEN call IS NOT NULL THEN 'Function not allowed: ' || call "
    "WHEN regexp_matches(t, '(?i)\\bcurrent_user\\b') THEN 'Function not allowed: current_user' "
    "WHEN contains(t, '->') THEN 'Function not allowed: ->' WHEN regexp_matches(t, '(?i)\\bcross\\b') THEN 'Cross joins are not allowed' "
    "WHEN regexp_matches(t, '(?i)`?\\b(default|marts|spark_catalog)`?\\s*\\.') THEN 'Only marts tables are accessible.' ELSE '' END AS refusal FROM calls")))
def q_refuse_statements(spark, sf):
    from ledgerline.sources.tables import read_table

    probes = G.probes_from_events(read_table(spark, sf, "events"))
    return probes.select("statement_id", "sql", G.refusal(F.col("sql"), _OUTSIDE).alias("refusal"))


def _database(spark, sf) -> str:
    """The database that the marts of one input are published in: a session's other inputs have their own."""
    import zlib

    return f"marts_{zlib.crc32(_input(spark, sf).encode()):08x}"


def _published(spark, sf, names=("mart_call_funnel", "mart_revenue", "mart_jobs"), database=None):
    from ledgerline.operators.marts import write_mart

    return {name: write_mart(spark, _marts(spark, sf)[name], name, database or _database(spark, sf)) for name in names}


GUARDED_SQL = ("SELECT service_description, sum(revenue_dollars) AS revenue, sum(transaction_count) AS transactions "
               "FROM marts.mart_revenue GROUP BY service_description ORDER BY revenue DESC")


@register("guarded_query", with_(base(("revenue",)), (
    f"SELECT service_description, {dbl('sum(revenue_cents)', 2)} AS revenue, "
    f"{b('sum(transaction_count)')} AS transactions FROM mart_revenue GROUP BY service_description "
    "ORDER BY sum(revenue_cents) DESC LIMIT 100")))
def q_guarded_query(spark, sf):
    from ledgerline.session import scratch_path

    _published(spark, sf, ("mart_revenue",))
    verdict = Q.verdict(Q.freshness(_raw_written(spark, sf), AS_OF_WARN))
    r = G.guarded_query(spark, GUARDED_SQL, verdict, audit_path=scratch_path(spark, "audit"), seconds=60, database=_database(spark, sf))
    if r.error:
        raise RuntimeError(f"{r.error}: {r.message}")
    return to_wire(r.data)


# Types of the mart columns as documented: all others are bigint.
_MART_TYPES = {
    "call_date": "date", "payment_date": "date", "service_description": "string", "payment_method": "string", "service_category": "string",
    "avg_duration_seconds": "decimal(38,1)", "avg_sentiment": "decimal(38,2)",
    "booking_rate_pct": "decimal(38,1)", "escalation_rate_pct": "decimal(38,1)", "miss_rate_pct": "decimal(38,1)",
    "revenue_dollars": "decimal(28,2)", "avg_ticket_dollars": "decimal(38,2)", "refund_dollars": "decimal(28,2)",
    "net_revenue_dollars": "decimal(29,2)", "completion_rate_pct": "decimal(38,1)", "avg_completed_value": "decimal(38,2)",
    "total_completed_value": "decimal(20,2)",
}


def _describe_sql() -> str:
    from ledgerline.schemas import MART_COLUMN_COMMENTS, MART_DESCRIPTIONS

    return " UNION ALL ".join(
        f"SELECT 'marts.{m}' AS \"table\", {O.q(MART_DESCRIPTIONS[m])} AS table_description, '{c}' AS \"column\", "
        f"'{_MART_TYPES.get(c, 'bigint')}' AS type, {O.q(text)} AS description, "
        f"(SELECT count(*) FROM {m}_wire) AS row_count, (SELECT count(*) FROM {m}_wire WHERE \"{c}\" IS NULL) AS null_count"
        for m, columns in MART_COLUMN_COMMENTS.items() for c, text in columns.items())


@register("describe_marts", with_(base() + [
    f"mart_call_funnel_wire AS (SELECT {O.FUNNEL_WIRE} FROM mart_call_funnel)",
    f"mart_revenue_wire AS (SELECT {O.REVENUE_WIRE} FROM mart_revenue)",
    f"mart_jobs_wire AS (SELECT {O.JOBS_WIRE} FROM mart_jobs)"], _describe_sql()))
def q_describe_marts(spark, sf):
    names = ("mart_call_funnel", "mart_revenue", "mart_jobs")
    return G.describe_marts({n: _served(spark, sf, n).drop(MONTH) for n in names})


# JSON lines as the writer emits them: keys in order, NULL members omitted
_AUDIT_LINE = (
    """'{"tool":"query_marts","input_sql":"' || replace(sql, chr(10), '\\n') || '",' || """
    """CASE WHEN reason = '' THEN '"executed_sql":"' || (""" + _CAP + """) || '",' """
    """ELSE '"rejected":true,"reason":"' || reason || '",' END || """
    """'"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '"}'"""
)


@register("audit_log", with_(_VET, f"SELECT {_AUDIT_LINE} AS line FROM vetted"))
def q_audit_log(spark, sf):
    from ledgerline.session import scratch_path

    vetted = G.cap(G.vet(_statements(spark, sf), "sql"), "sql")
    path = scratch_path(spark, "audit")
    G.append_audit(G.audit_lines(vetted), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


# ---------------------------------------------------------------------------
# lake, raw load and materialisation (SRC-1..4, SNK-1..6)
# ---------------------------------------------------------------------------

import datetime as _dt  # noqa: E402

from ledgerline.schemas import CALL_COLUMNS, JOB_COLUMNS, PAYMENT_COLUMNS, SOURCES, extract_schema  # noqa: E402
from ledgerline.sources import lake as L  # noqa: E402
from ledgerline.sources.tables import damaged_extracts, extracts  # noqa: E402

RUN_1 = _dt.datetime(2024, 1, 30, 6, 0, 0)
RUN_2 = _dt.datetime(2024, 1, 31, 6, 0, 0)

_CALL_COLS = ", ".join(f'"{c}"' for c in CALL_COLUMNS)


def _lake_root(spark):
    from ledgerline.session import scratch_path

    return scratch_path(spark, "lake")


@register("lake_write_overwrite", with_(O.raw_ctes(), f"SELECT {_CALL_COLS} FROM raw_calls"))
def q_lake_write_overwrite(spark, sf):
    root = _lake_root(spark)
    L.write_lake(damaged_extracts(spark, sf)["calls"], root, "calls", RUN_1)
    L.write_lake(extracts(spark, sf)["calls"], root, "calls", RUN_2)  # replaces run 1
    return L.read_lake(spark, root, "calls", extract_schema(CALL_COLUMNS))


def _calls_extract_sql(damaged: bool) -> str:
    return f"{O._calls_select(damaged)} FROM ev"


@register("lake_write_append", with_([O.EV], (
    f"{_calls_extract_sql(True)} UNION ALL {_calls_extract_sql(False)}")))
def q_lake_write_append(spark, sf):
    root = _lake_root(spark)
    L.write_lake(damaged_extracts(spark, sf)["calls"], root, "calls", RUN_1, append=True)
    L.write_lake(extracts(spark, sf)["calls"], root, "calls", RUN_2, append=True)
    return L.read_lake(spark, root, "calls", extract_schema(CALL_COLUMNS))


@register("lake_read_all", with_(O.raw_ctes(), (
    f"SELECT {', '.join(f'{chr(34)}{c}{chr(34)}' for c in PAYMENT_COLUMNS)} FROM raw_payments")))
def q_lake_read_all(spark, sf):
    root = _lake_root(spark)
    L.write_lake(extracts(spark, sf)["payments"], root, "payments", RUN_1)
    return L.read_lake(spark, root, "payments", extract_schema(PAYMENT_COLUMNS))


@register("lake_read_latest", with_(O.raw_ctes(), f"SELECT {_CALL_COLS} FROM raw_calls"))
def q_lake_read_latest(spark, sf):
    root = _lake_root(spark)
    L.write_lake(damaged_extracts(spark, sf)["calls"], root, "calls", RUN_1, append=True)
    L.write_lake(extracts(spark, sf)["calls"], root, "calls", RUN_2, append=True)
    return L.read_lake(spark, root, "calls", extract_schema(CALL_COLUMNS), latest=True)


@register("empty_source", with_(O.raw_ctes(), (
    "SELECT 'calls' AS source, count(*) AS \"rows\" FROM raw_calls UNION ALL "
    "SELECT 'payments', count(*) FROM raw_payments UNION ALL SELECT 'jobs', 0")))
def q_empty_source(spark, sf):
    root = _lake_root(spark)
    ex = extracts(spark, sf)
    for name in ("calls", "payments"):  # jobs never landed
        L.write_lake(ex[name], root, name, RUN_1)
    frames = {name: L.read_lake(spark, root, name, extract_schema(cols), latest=(name == "jobs"))
              for name, cols in SOURCES.items()}
    return marts.row_counts(frames)


@register("jobs_documents", with_(O.raw_ctes(), (
    "SELECT job_id, related_call_id, status, service_category, CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS value, "
    "technician, scheduled_at, nullif(completed_at, '') AS completed_at FROM raw_jobs")))
def q_jobs_documents(spark, sf):
    from ledgerline.sources.documents import export_documents, read_documents

    path = _lake_root(spark) + "/jobs_export"
    export_documents(extracts(spark, sf)["jobs"], path)
    return to_wire(read_documents(spark, path))


@register("raw_load", with_(O.raw_ctes(), f"SELECT {_CALL_COLS}, {tsf('_loaded_at')} AS _loaded_at FROM raw_calls"))
def q_raw_load(spark, sf):
    from ledgerline.operators.raw import load_raw, read_raw
    from ledgerline.plans.pipeline import LOADED_AT

    root = _lake_root(spark)
    L.write_lake(extracts(spark, sf)["calls"], root, "calls", RUN_2)
    landed = L.read_lake(spark, root, "calls", extract_schema(CALL_COLUMNS))
    path = root + "/warehouse/raw/calls"
    load_raw(landed, CALL_COLUMNS, LOADED_AT["calls"], path)
    return to_wire(read_raw(spark, CALL_COLUMNS, path))


@register("raw_schema", with_(O.raw_ctes(), (
    f"SELECT {', '.join(f'{chr(34)}{c}{chr(34)}' for c in JOB_COLUMNS)}, {tsf('_loaded_at')} AS _loaded_at "
    "FROM raw_jobs")))
def q_raw_schema(spark, sf):
    from ledgerline.operators.raw import load_raw, read_raw
    from ledgerline.plans.pipeline import LOADED_AT

    path = _lake_root(spark) + "/warehouse/raw/jobs"
    load_raw(extracts(spark, sf)["jobs"], JOB_COLUMNS, LOADED_AT["jobs"], path)
    return to_wire(read_raw(spark, JOB_COLUMNS, path))  # read with the all-text raw schema


@register("staging_views", ORACLE["stg_payments"])
def q_staging_views(spark, sf):
    from ledgerline.operators.staging import register_staging

    register_staging(spark, layers(spark, sf).raw)
    return to_wire(spark.table("stg_payments"))


@register("mart_tables", ORACLE["mart_jobs"])
def q_mart_tables(spark, sf):
    _published(spark, sf, ("mart_jobs",))
    return to_wire(spark.table(f"{_database(spark, sf)}.mart_jobs"))


# ---------------------------------------------------------------------------
# streaming (STR-1, STR-2)
# ---------------------------------------------------------------------------


@register("request_rate_stream", with_([_LOG], (
    f"SELECT {tsf(_win(1))} AS window_start, {tsf(_win(1) + ' + INTERVAL 1 MINUTE')} AS window_end, "
    "count(*) AS requests, count(*) / 60 AS rps, "
    "count(*) FILTER (WHERE status = 500) AS errors, "
    "count(*) FILTER (WHERE status = 500) / count(*) AS error_ratio "
    f"FROM log GROUP BY {_win(1)} HAVING {_win(1)} + INTERVAL 1 MINUTE <= "
    "(SELECT max(ts) FROM log) - INTERVAL 5 MINUTE")))
def q_request_rate_stream(spark, sf):
    from ledgerline.session import scratch_path
    from ledgerline.streaming.requests import run_request_rate

    base_ = scratch_path(spark, "stream")
    run_request_rate(spark, f"{sf.rstrip('/')}/events.parquet", base_ + "/out", base_ + "/checkpoint")
    return to_wire(spark.read.parquet(base_ + "/out"))


@register("lake_ingest_stream", with_(O.raw_ctes(), (
    f"SELECT {_CALL_COLS}, {tsf('_loaded_at')} AS _loaded_at FROM raw_calls UNION ALL "
    f"SELECT {_CALL_COLS}, {tsf('_loaded_at')} AS _loaded_at FROM raw_calls")))
def q_lake_ingest_stream(spark, sf):
    from ledgerline.plans.pipeline import LOADED_AT
    from ledgerline.streaming.ingest import ingest_stream

    root = _lake_root(spark)
    out, ck = root + "/warehouse/raw/calls", root + "/checkpoints/calls"
    calls = extracts(spark, sf)["calls"]
    # two runs land one after the other; each stream run ingests only new files
    L.write_lake(calls, root, "calls", RUN_1, append=True)
    ingest_stream(spark, root, "calls", CALL_COLUMNS, out, ck, LOADED_AT["calls"])
    L.write_lake(calls, root, "calls", RUN_2, append=True)
    ingest_stream(spark, root, "calls", CALL_COLUMNS, out, ck, LOADED_AT["calls"])
    return to_wire(spark.read.parquet(out))


# ---------------------------------------------------------------------------
# incremental marts and snapshots (AGG-2..4, SNK-6)
# ---------------------------------------------------------------------------

from ledgerline.operators import refresh as I  # noqa: E402
from ledgerline.sources.snapshots import SnapshotStore  # noqa: E402

#: What the second load brings: rows from these days on, and payments of an earlier month that come late.
SECOND_PAYMENTS = "(timestamp >= '1998' OR (timestamp >= '1995-03' AND timestamp < '1995-04' AND payment_method = 'ach'))"
SECOND_CALLS = "timestamp >= '2024-01-21'"
SECOND_JOBS = "scheduled_at >= '1998'"


def _two_loads(spark, sf):
    """All raw rows dealt to two loads, the second one with late rows and with jobs for calls of the first."""
    raw = _raw_written(spark, sf)
    second = {"payments": SECOND_PAYMENTS, "calls": SECOND_CALLS, "jobs": SECOND_JOBS}
    return [{s: raw[s].where(f"coalesce({c}, false) = {later}") for s, c in second.items()} for later in ("false", "true")]


def _refreshed(spark, sf):
    """A store that two loads were brought into, the second one twice."""

    def build():
        from ledgerline.session import scratch_path

        store = SnapshotStore(spark, scratch_path(spark, "store"))
        first, second = _two_loads(spark, sf)
        for name, load in (("load-1", first), ("load-2", second), ("load-2", second)):
            I.apply_load(store, name, load)
        return store

    return _written(spark, sf, "store", build)


@register("mart_revenue_refreshed", ORACLE["mart_revenue"])
def q_mart_revenue_refreshed(spark, sf):
    return to_wire(I.read_mart(_refreshed(spark, sf), "mart_revenue"))


@register("mart_call_funnel_refreshed", ORACLE["mart_call_funnel"])
def q_mart_call_funnel_refreshed(spark, sf):
    return to_wire(I.read_mart(_refreshed(spark, sf), "mart_call_funnel"))


@register("mart_jobs_refreshed", ORACLE["mart_jobs"])
def q_mart_jobs_refreshed(spark, sf):
    return to_wire(I.read_mart(_refreshed(spark, sf), "mart_jobs"))


def _load_ctes(load: int) -> list[str]:
    """Raw and staging layers of one load."""
    out = []
    for cte in O.raw_ctes() + O.STG:
        for table, later in (("payments", SECOND_PAYMENTS), ("calls", SECOND_CALLS), ("jobs", SECOND_JOBS)):
            if cte.startswith(f"raw_{table} AS ("):
                later = later.replace("timestamp", '"timestamp"')
                cte = f"raw_{table} AS (SELECT * FROM ({cte[len(f'raw_{table} AS ('):-1]}) WHERE ({later}) = {str(load == 2).lower()})"
        out.append(cte)
    return out


@register("mart_revenue_as_of", with_(_load_ctes(1) + O.MART_REVENUE, f"SELECT {O.REVENUE_WIRE} FROM mart_revenue"))
def q_mart_revenue_as_of(spark, sf):
    """The revenue mart of the first version, read after the second was committed."""
    store = _refreshed(spark, sf)
    with store.pinned(1) as first:
        return to_wire(I.read_mart(store, "mart_revenue", first))


def _months(column: str, table: str) -> str:
    return f"SELECT DISTINCT strftime({column}, '%Y-%m') AS m FROM {table}"


def _history_sql() -> str:
    ctes = [O.EV]
    for load in (1, 2):
        for cte in _load_ctes(load)[1:]:
            name, body = cte.split(" AS ", 1)
            for table in ("payments", "calls", "jobs"):
                body = body.replace(f"FROM raw_{table}", f"FROM raw_{table}_{load}")
            ctes.append(f"{name}_{load} AS {body}")
    ctes += [
        f"pay_1 AS ({_months('payment_timestamp', 'stg_payments_1')})", f"pay_2 AS ({_months('payment_timestamp', 'stg_payments_2')})",
        f"day_1 AS ({_months('call_timestamp', 'stg_calls_1')})",
        f"day_2 AS ({_months('call_timestamp', 'stg_calls_2')} UNION {_months('call_timestamp', 'stg_calls_1 JOIN stg_jobs_2 ON related_call_id = call_id')})"]
    rows = [f"SELECT {v} AS version, 'load load-{v}' AS operation, '{t}' AS \"table\", {p} AS parts, {n} AS rewritten, {k} AS kept"
            for t, grows in (("call_days", 1), ("call_jobs", 1), ("loads", 1), ("mart_jobs", 0)) for v, p, n, k in ((1, 1, 1, 0), (2, 1 + grows, 1, grows))]
    for table, m in (("mart_revenue", "pay"), ("mart_call_funnel", "day")):
        rows.append(f"SELECT 1, 'load load-1', '{table}', (SELECT count(*) FROM {m}_1), (SELECT count(*) FROM {m}_1), 0")
        rows.append(f"SELECT 2, 'load load-2', '{table}', (SELECT count(*) FROM (SELECT m FROM {m}_1 UNION SELECT m FROM {m}_2)), "
                    f"(SELECT count(*) FROM {m}_2), (SELECT count(*) FROM {m}_1 WHERE m NOT IN (SELECT m FROM {m}_2))")
    return with_(ctes, " UNION ALL ".join(rows))


@register("refresh_history", _history_sql())
def q_refresh_history(spark, sf):
    return _refreshed(spark, sf).history()


# ---------------------------------------------------------------------------
# joins on bucketed tables (JON-1, JON-3)
# ---------------------------------------------------------------------------

def _bucketed(spark, sf, damaged=False):
    """Database with the calls and jobs of an input in buckets of the call id, written once."""
    from ledgerline.operators.bucketed import write_bucketed

    def build():
        database = _database(spark, sf) + ("_damaged" if damaged else "")
        stg = layers(spark, sf, damaged).staging
        write_bucketed(stg["calls"], stg["jobs"], database)
        return database

    return _written(spark, sf, ("bucketed", damaged), build)


@register("calls_jobs_daily_bucketed", ORACLE["calls_jobs_daily"])
def q_calls_jobs_daily_bucketed(spark, sf):
    from ledgerline.operators import bucketed

    return to_wire(bucketed.jobs_by_call_day(spark, _bucketed(spark, sf)))


@register("call_job_consistency_bucketed", ORACLE["call_job_consistency"])
def q_call_job_consistency_bucketed(spark, sf):
    from ledgerline.operators import bucketed

    return bucketed.call_job_mismatches(spark, _bucketed(spark, sf, damaged=True))


# ---------------------------------------------------------------------------
# counters and mergeable quantiles (OBS-6..9)
# ---------------------------------------------------------------------------

from ledgerline.operators import samples as C  # noqa: E402


def _increase_ctes(seconds: int = 3600) -> list[str]:
    edge = "CASE WHEN {0} >= span / (samples - 1) * 1.1::DOUBLE THEN span / (samples - 1) / 2 ELSE {0} END"
    head, tail = edge.format("(t1 - w)::DOUBLE"), edge.format(f"(w + {seconds} - t2)::DOUBLE")
    return [
        _LOG,
        "per_minute AS (SELECT endpoint, status, epoch_us(ts) // 60000000 AS m, count(*) AS n FROM log GROUP BY ALL)",
        f"counters AS (SELECT endpoint, status, (m + 1) * 60 AS t, sum(n) OVER (PARTITION BY endpoint, status, m * 60 // {C.RESTART_SECONDS} ORDER BY m) AS value FROM per_minute)",
        f"placed AS (SELECT *, (t - 1) // {seconds} * {seconds} AS w FROM counters)",
        "steps AS (SELECT *, lag(value) OVER (PARTITION BY endpoint, status, w ORDER BY t) AS prev FROM placed)",
        "seen AS (SELECT endpoint, status, w, count(*) AS samples, count(*) FILTER (WHERE value < prev) AS resets, min(t) AS t1, max(t) AS t2, "
        "arg_min(value, t) AS v1, (arg_max(value, t) - arg_min(value, t) + coalesce(sum(prev) FILTER (WHERE value < prev), 0))::DOUBLE AS seen, (max(t) - min(t))::DOUBLE AS span "
        "FROM steps GROUP BY ALL HAVING count(*) > 1)",
        f"edges AS (SELECT *, CASE WHEN seen > 0 THEN least({head}, span * (v1::DOUBLE / seen)) ELSE {head} END AS head, {tail} AS tail FROM seen)",
        "increases AS (SELECT endpoint, status, make_timestamp(w * 1000000) AS window_start, samples, resets, seen * ((span + head + tail) / span) AS increase, "
        f"seen * ((span + head + tail) / span) / {seconds} AS rate FROM edges)",
    ]


@register("counter_increase", with_(_increase_ctes(), f"SELECT endpoint, status, {tsf('window_start')} AS window_start, samples, resets, increase, rate FROM increases"))
def q_counter_increase(spark, sf):
    return to_wire(C.counter_increase(C.counter_samples(_log(spark, sf))))


@register("counter_error_ratio", with_(_increase_ctes(), (
    f"SELECT {tsf('window_start')} AS window_start, round(sum(rate), 9) AS rps, "
    "round(coalesce(sum(rate) FILTER (WHERE status::VARCHAR LIKE '5__'), 0) / sum(rate), 9) AS error_ratio FROM increases GROUP BY window_start")))
def q_counter_error_ratio(spark, sf):
    return to_wire(C.counter_error_ratio(C.counter_increase(C.counter_samples(_log(spark, sf)))))


def _sketches(spark, sf):
    """Duration sketches by minute, written once; all coarser windows are merged from them."""
    from ledgerline.plans.pipeline import materialize

    return _written(spark, sf, "sketches", lambda: materialize(spark, {"sketches": C.duration_sketches(_log(spark, sf))})["sketches"])


@register("latency_sketch_windows", with_([_LOG], (
    "SELECT size, " + tsf("w") + " AS window_start, count(*) AS requests, true AS p50_ok, true AS p95_ok, true AS p99_ok FROM ("
    "SELECT '5 minutes' AS size, time_bucket(INTERVAL 5 MINUTE, ts) AS w FROM log WHERE duration_ms IS NOT NULL UNION ALL "
    "SELECT '1 hour', date_trunc('hour', ts) FROM log WHERE duration_ms IS NOT NULL UNION ALL "
    "SELECT '1 day', date_trunc('day', ts)::TIMESTAMP FROM log WHERE duration_ms IS NOT NULL) GROUP BY size, w")))
def q_latency_sketch_windows(spark, sf):
    """Quantiles of 5 minutes, hours and days, each merged from the next finer one, held against exact ranks."""
    log, parts = _log(spark, sf), []
    finer, at = _sketches(spark, sf), "minute"
    for size in ("5 minutes", "1 hour", "1 day"):
        finer, at = C.merge_sketches(finer, size, at), "window_start"
        errors = C.rank_errors(C.sketch_quantiles(finer), log, size)
        parts.append(errors.select(F.lit(size).alias("size"), "window_start", "requests", *[(F.col(f"{p}_error") <= C.RANK_ERROR).alias(f"{p}_ok") for p in ("p50", "p95", "p99")]))
    return to_wire(parts[0].unionByName(parts[1]).unionByName(parts[2]))


# ---------------------------------------------------------------------------
# data tests merged load by load (DQ-1..4)
# ---------------------------------------------------------------------------

from ledgerline.operators import suite_state as S  # noqa: E402

LOADED_TESTS = [t for t in Q.DEFAULT_SUITE if t.layer != "marts"]


def _tested_loads(spark, sf):
    """A store of test results that the damaged rows were brought into by two loads, the second one twice."""
    from ledgerline.operators.staging import inline_views

    def build():
        from ledgerline.session import scratch_path

        store, raw = SnapshotStore(spark, scratch_path(spark, "tests")), _raw_written(spark, sf, damaged=True)
        cut = {"payments": SECOND_PAYMENTS, "calls": SECOND_CALLS, "jobs": SECOND_JOBS}
        for name, later in (("load-1", "false"), ("load-2", "true"), ("load-2", "true")):
            S.apply_tests(store, name, {f"raw.{s}": raw[s].where(f"coalesce({c}, false) = {later}") for s, c in cut.items()}, LOADED_TESTS, inline_views())
        return store

    return _written(spark, sf, "tested", build)


@register("dq_suite_merged", with_(base(damaged=True) + [_suite_sql()], (
    "SELECT layer, model, \"column\", test, CAST(failures AS BIGINT) AS failures, "
    "CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM suite WHERE layer <> 'marts'")))
def q_dq_suite_merged(spark, sf):
    from ledgerline.operators.staging import inline_views

    return S.suite_results(_tested_loads(spark, sf), LOADED_TESTS, inline_views())


_BROKEN_JOBS = "mod(cast(regexp_extract(job_id, '[0-9]+', 0) as bigint), 97) = 0"


@register("dq_suite_isolated", with_(base(damaged=True) + [_suite_sql()], (
    "SELECT layer, model, \"column\", test, CASE WHEN model IN ('raw.jobs', 'stg_jobs') THEN NULL ELSE CAST(failures AS BIGINT) END AS failures, "
    "CASE WHEN model IN ('raw.jobs', 'stg_jobs') THEN 'error' WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM suite WHERE layer <> 'marts'")))
def q_dq_suite_isolated(spark, sf):
    """Some jobs carry a text for a price, which staging cannot read: the tests on that source are errors, all others run."""
    from ledgerline.operators.staging import inline_views, staging

    raw = dict(_raw_written(spark, sf, damaged=True))
    raw["jobs"] = raw["jobs"].withColumn("value", F.when(F.expr(_BROKEN_JOBS), "n/a").otherwise(F.col("value")))
    return Q.run_suite_isolated(Q.layer_tables(raw, staging(raw), {}), LOADED_TESTS, views=inline_views())


# ---------------------------------------------------------------------------
# all tools under the gate, with their audit lines (DQ-9, SQL-5)
# ---------------------------------------------------------------------------

ASKED_SQL = "SELECT service_category, total_jobs FROM marts.mart_jobs"


def _conversations(spark, sf):
    """Every tool asked once while sources age and once while one is stale; the audit folder and the answers' envelopes."""
    from ledgerline.operators.tools import Tools
    from ledgerline.session import scratch_path

    def build():
        path, rows = scratch_path(spark, "audit"), []
        names = ("mart_call_funnel", "mart_revenue", "mart_jobs")
        _published(spark, sf, ("mart_jobs",))
        for state, as_of in (("warn", AS_OF_WARN), ("stale", AS_OF)):
            verdict = Q.verdict(Q.freshness(_raw_written(spark, sf), as_of))
            tools = Tools(spark, {n: _served(spark, sf, n) for n in names}, verdict, path, _database(spark, sf))
            asked = {"revenue total": tools.revenue_summary(REVENUE_FROM, REVENUE_TO), "revenue by service": tools.revenue_summary(group_by="service"),
                     "revenue by date": tools.revenue_summary(REVENUE_FROM, REVENUE_TO, "date"), "funnel": tools.call_funnel(FUNNEL_FROM, FUNNEL_TO),
                     "jobs": tools.job_completion(), "jobs of a category": tools.job_completion(CATEGORY), "ad hoc": tools.query_marts(ASKED_SQL, seconds=60)}
            rows += [(state, name, r.error, r.message, r.caveat, r.row_count) for name, r in asked.items()]
        return path, spark.createDataFrame(rows, "state string, question string, error string, message string, caveat string, row_count long")

    return _written(spark, sf, "conversations", build)


def _tool_counts() -> list[str]:
    return [
        "counts(question, tool, input, n) AS (SELECT 'revenue total', 'revenue_summary', "
        f"'date_from={REVENUE_FROM}, date_to={REVENUE_TO}', 1 UNION ALL "
        "SELECT 'revenue by service', 'revenue_summary', 'group_by=service', (SELECT count(DISTINCT service_description) FROM mart_revenue) UNION ALL "
        f"SELECT 'revenue by date', 'revenue_summary', 'date_from={REVENUE_FROM}, date_to={REVENUE_TO}, group_by=date', "
        f"(SELECT count(DISTINCT payment_date) FROM mart_revenue {_REV_WHERE}) UNION ALL "
        f"SELECT 'funnel', 'call_funnel', 'date_from={FUNNEL_FROM}, date_to={FUNNEL_TO}', 1 UNION ALL "
        "SELECT 'jobs', 'job_completion', '', (SELECT count(*) FROM mart_jobs) UNION ALL "
        f"SELECT 'jobs of a category', 'job_completion', 'category={CATEGORY}', (SELECT count(*) FROM mart_jobs WHERE service_category = '{CATEGORY}') UNION ALL "
        f"SELECT 'ad hoc', 'query_marts', 'sql={ASKED_SQL}', (SELECT least(100, count(*)) FROM mart_jobs))",
    ]


def _both_verdicts() -> list[str]:
    """The verdict of each of the two clocks."""
    out = []
    for state, as_of in (("warn", AS_OF_WARN), ("stale", AS_OF)):
        for cte in _freshness_ctes(as_of):
            for name in ("last", "fresh", "verdict"):
                cte = cte.replace(f"{name} AS (", f"{name}_{state} AS (") if cte.startswith(f"{name} AS (") else cte
            out.append(cte.replace("FROM last)", f"FROM last_{state})").replace("FROM fresh)", f"FROM fresh_{state})"))
    return out


_TOOLS = base() + _both_verdicts() + _tool_counts()


@register("tool_answers", with_(_TOOLS, (
    "SELECT 'warn' AS state, question, NULL AS error, NULL AS message, (SELECT message FROM verdict_warn) AS caveat, CAST(n AS BIGINT) AS row_count FROM counts UNION ALL "
    "SELECT 'stale', question, 'data_stale', (SELECT message FROM verdict_stale), NULL, NULL FROM counts")))
def q_tool_answers(spark, sf):
    return _conversations(spark, sf)[1]


@register("tool_audit", with_(_TOOLS, (
    "SELECT tool, input, CAST(n AS BIGINT) AS row_count, false AS rejected, NULL AS reason, true AS timed FROM counts UNION ALL "
    "SELECT tool, input, NULL, true, (SELECT message FROM verdict_stale), true FROM counts")))
def q_tool_audit(spark, sf):
    from ledgerline.operators.tools import read_audit

    return read_audit(spark, _conversations(spark, sf)[0])


# ---------------------------------------------------------------------------
# all band sets (OBS-3); records that are no JSON (STR-2)
# ---------------------------------------------------------------------------

def _all_bands_sql() -> str:
    chain = "CASE metric " + " ".join(
        f"WHEN '{m}' THEN " + ("CASE " + " ".join(f"WHEN value >= {x} THEN '{c}'" for x, c in reversed(steps)) + " ELSE 'green' END") for m, steps in M.BANDS.items()) + " END"
    return f"SELECT metric, label, value, CASE WHEN value IS NOT NULL THEN {chain} END AS band FROM panel"


@register("metric_bands", with_(base(damaged=True) + _gate_ctes() + _quantile_sql() + [
    "panel AS (SELECT 'run_seconds' AS metric, '' AS label, " + f"{RUN_SECONDS}::DOUBLE AS value UNION ALL "
    + " UNION ALL ".join(f"SELECT 'age_seconds', '{s}', (SELECT epoch({O.ts_lit(AS_OF)} - max(_loaded_at))::DOUBLE FROM raw_{s})" for s in ("calls", "payments", "jobs"))
    + f" UNION ALL SELECT 'latency_ms', {tsf('w')}, p95 FROM quant UNION ALL "
    f"SELECT 'error_ratio', {tsf(_win(5))}, count(*) FILTER (WHERE status = 500) / count(*) FROM log GROUP BY {_win(5)} UNION ALL "
    "SELECT 'failed_tests', '', (SELECT coalesce(sum(n) FILTER (WHERE status IN ('fail', 'error')), 0)::DOUBLE FROM counts))"], _all_bands_sql()))
def q_metric_bands(spark, sf):
    """Every panel with thresholds: run time, ages of the sources, latency and error ratio by window, failed tests."""
    ages = Q.freshness(_raw_written(spark, sf), AS_OF).select(
        F.lit("age_seconds").alias("metric"), F.col("source").alias("label"),
        F.expr(f"timestampdiff(SECOND, last_loaded, TIMESTAMP_NTZ '{AS_OF.isoformat(sep=' ')}')").cast("double").alias("value"))
    at = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("label")
    log = _log(spark, sf)
    parts = [spark.createDataFrame([("run_seconds", "", float(RUN_SECONDS))], "metric string, label string, value double"), ages,
             M.latency_quantiles(log).select(F.lit("latency_ms").alias("metric"), at, F.col("p95").alias("value")),
             M.error_ratio(log).select(F.lit("error_ratio").alias("metric"), at, F.col("error_ratio").alias("value")),
             M.failed_tests(_artifact_counts(spark, sf)).select(F.lit("failed_tests").alias("metric"), F.lit("").alias("label"), F.col("failed_tests").cast("double").alias("value"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return M.band_all(out)


@register("ingest_quarantine", with_(O.raw_ctes(), (
    "SELECT 'loaded' AS kind, count(*) AS records, count(DISTINCT call_id) AS calls FROM raw_calls WHERE CAST(call_id AS BIGINT) % 50 <> 0 UNION ALL "
    "SELECT 'quarantined', count(*), count(DISTINCT call_id) FROM raw_calls WHERE CAST(call_id AS BIGINT) % 50 = 0")))
def q_ingest_quarantine(spark, sf):
    """Two runs of call extracts, each with some cut-off lines, taken in by streams one after the other."""
    from ledgerline.plans.pipeline import LOADED_AT
    from ledgerline.streaming.ingest import ingest_stream_checked

    root = _lake_root(spark)
    out, bad, ck = root + "/warehouse/raw/calls", root + "/warehouse/quarantine/calls", root + "/checkpoints/calls"
    whole = extracts(spark, sf)["calls"].withColumn("line", F.to_json(F.struct(*CALL_COLUMNS)))
    cut = F.expr("substring(line, 1, length(line) - 9)")
    lines = whole.select("timestamp", F.when(F.col("call_id").cast("long") % 50 == 0, cut).otherwise(F.col("line")).alias("value"))
    for run_ts, rows in ((RUN_1, lines.where(f"not ({SECOND_CALLS})")), (RUN_2, lines.where(SECOND_CALLS))):
        rows.select("value").write.text(L.run_dir(root, "calls", run_ts))
        ingest_stream_checked(spark, root, "calls", CALL_COLUMNS, out, bad, ck, LOADED_AT["calls"])
    loaded = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("records"), F.count_distinct("call_id").alias("calls"))
    kept = spark.read.parquet(bad).agg(F.count(F.lit(1)).alias("records"), F.count_distinct(F.regexp_extract("record", '"call_id":"([0-9]+)"', 1)).alias("calls"))
    return loaded.select(F.lit("loaded").alias("kind"), "records", "calls").unionByName(kept.select(F.lit("quarantined").alias("kind"), "records", "calls"))
