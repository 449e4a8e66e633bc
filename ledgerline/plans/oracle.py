"""Independent DuckDB SQL for the correctness check.

Every statement starts from the benchmark tables (views ``events``,
``lineitem``, ``part``, ``orders``), re-derives the raw / staging / mart layers
as CTEs and computes the answer. Rounded measures are carried as integers in
10^-d units and rounded half away from zero with integer arithmetic, then
turned into doubles at the end, the same values the Spark side serves.
"""

from __future__ import annotations

import datetime as dt

from ledgerline.plans.pipeline import LOADED_AT
from ledgerline.sources.tables import (
    JOB_STATUS_BY_ORDERSTATUS,
    METHOD_BY_LINESTATUS,
    OUTCOME_BY_EVENT,
    STATUS_BY_RETURNFLAG,
    TOPICS,
)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ts_lit(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t.strftime('%Y-%m-%d %H:%M:%S')}'"


def case_map(expr: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} END"


def hu(num: str, den: str, digits: int, num_scale: int = 0) -> str:
    """Integer count of 10^-digits units of round(num*10^-num_scale/den, digits)."""
    p = 10 ** (digits - num_scale)
    return (f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 THEN NULL ELSE "
            f"sign({num}) * ((2 * abs(CAST({num} AS HUGEINT)) * {p} + ({den})) // (2 * ({den}))) END)")


def dbl(units: str, digits: int) -> str:
    return f"(CAST({units} AS DOUBLE) / {10 ** digits})"


def d(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d')"


def tsf(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ---------------------------------------------------------------------------
# extracts / raw
# ---------------------------------------------------------------------------

def _topic_of(key: str) -> str:
    return (f"CASE {key} % {len(TOPICS)} " + " ".join(f"WHEN {i} THEN {q(t)}" for i, t in enumerate(TOPICS[:-1]))
            + f" ELSE {q(TOPICS[-1])} END")


EV = ("ev AS (SELECT event_id, ts, user_id, event_type, value, "
      "CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
      f"{_topic_of('user_id')} AS topic FROM events)")


def _calls_select(damaged: bool) -> str:
    urgency = ("CASE WHEN k < 30 THEN 'low' WHEN k < 75 THEN 'medium' "
               "WHEN k < 95 THEN 'high' ELSE 'critical' END")
    outcome = case_map("event_type", OUTCOME_BY_EVENT)
    if damaged:
        urgency = f"CASE WHEN k % 10 = 0 THEN NULL ELSE {urgency} END"
        outcome = f"CASE WHEN k = 0 THEN 'unknown' ELSE {outcome} END"
    return (
        "SELECT CAST(event_id AS VARCHAR) AS call_id, CAST(ts AS VARCHAR) AS \"timestamp\", "
        "'Caller ' || CAST(user_id % 15 AS VARCHAR) AS caller_name, "
        "'+1' || CAST(2000000000 + user_id AS VARCHAR) AS caller_phone, "
        f"{urgency} AS urgency, topic, {outcome} AS outcome, "
        "CAST(15 + CAST(floor(value) AS INTEGER) AS VARCHAR) AS duration_seconds, "
        "CAST(CAST((30 + k % 71) / 100.0 AS DECIMAL(3,2)) AS VARCHAR) AS sentiment_score, "
        "'agent-' || CAST(user_id % 3 + 1 AS VARCHAR) AS agent_id"
    )


def _payments_select() -> str:
    return (
        "SELECT 'pi_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS payment_id, "
        "CAST(l_shipdate AS VARCHAR) AS \"timestamp\", "
        "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS amount_cents, "
        "'usd' AS currency, "
        f"{case_map('l_returnflag', STATUS_BY_RETURNFLAG)} AS status, "
        f"{case_map('l_linestatus', METHOD_BY_LINESTATUS)} AS payment_method, "
        "'customer' || CAST(100 + l_orderkey % 900 AS VARCHAR) || '@example.com' AS customer_email, "
        "p_type AS description, 'booking' AS metadata_source"
    )


def _jobs_select() -> str:
    return (
        "SELECT 'job_' || CAST(o_orderkey AS VARCHAR) || suffix AS job_id, "
        "CAST(o_orderkey AS VARCHAR) AS related_call_id, "
        f"{case_map('o_orderstatus', JOB_STATUS_BY_ORDERSTATUS)} AS status, "
        f"{_topic_of('o_custkey')} AS service_category, "
        "CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS value, "
        "'tech-' || CAST(o_custkey % 8 AS VARCHAR) AS technician, "
        "CAST(o_orderdate AS VARCHAR) AS scheduled_at, "
        "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 1 DAY AS VARCHAR) ELSE '' END AS completed_at"
    )


def _raw_cols(cols: list[str]) -> str:
    return ", ".join(f"coalesce(\"{c}\", '') AS \"{c}\"" for c in cols)


def raw_ctes(loaded_at: dict | None = None, damaged: bool = False) -> list[str]:
    from ledgerline.schemas import CALL_COLUMNS, JOB_COLUMNS, PAYMENT_COLUMNS

    la = loaded_at or LOADED_AT
    calls = f"raw_calls AS (SELECT {_raw_cols(CALL_COLUMNS)}, {ts_lit(la['calls'])} AS _loaded_at FROM ({_calls_select(damaged)} FROM ev))"
    if damaged:
        lines = "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)"
        orders = "(SELECT *, '' AS suffix FROM orders UNION ALL SELECT *, '_b' FROM orders WHERE o_orderkey % 7 = 0)"
    else:
        lines = "lineitem"
        orders = "(SELECT *, '' AS suffix FROM orders)"
    pays = (f"raw_payments AS (SELECT {_raw_cols(PAYMENT_COLUMNS)}, {ts_lit(la['payments'])} AS _loaded_at FROM "
            f"({_payments_select()} FROM {lines} li JOIN part ON li.l_partkey = part.p_partkey))")
    jobs = (f"raw_jobs AS (SELECT {_raw_cols(JOB_COLUMNS)}, {ts_lit(la['jobs'])} AS _loaded_at FROM "
            f"({_jobs_select()} FROM {orders} o))")
    return [EV, calls, pays, jobs]


# ---------------------------------------------------------------------------
# staging (cents / hundredths kept as integers)
# ---------------------------------------------------------------------------

STG = [
    "stg_calls AS (SELECT call_id, CAST(\"timestamp\" AS TIMESTAMP) AS call_timestamp, caller_name, "
    "caller_phone, urgency, topic, outcome, CAST(duration_seconds AS INTEGER) AS duration_seconds, "
    "CAST(sentiment_score AS DECIMAL(3,2)) AS sentiment_score, "
    "CAST(CAST(sentiment_score AS DECIMAL(3,2)) * 100 AS INTEGER) AS sentiment_x100, agent_id "
    "FROM raw_calls WHERE call_id IS NOT NULL AND \"timestamp\" IS NOT NULL)",
    "stg_payments AS (SELECT payment_id, CAST(\"timestamp\" AS TIMESTAMP) AS payment_timestamp, "
    "CAST(amount_cents AS INTEGER) AS amount_cents, currency, status, payment_method, customer_email, "
    "description AS service_description, metadata_source "
    "FROM raw_payments WHERE payment_id IS NOT NULL AND status <> 'failed')",
    "stg_jobs AS (SELECT job_id, related_call_id, status AS job_status, service_category, "
    "CAST(value AS DECIMAL(10,2)) AS job_value, CAST(CAST(value AS DECIMAL(10,2)) * 100 AS BIGINT) AS job_value_x100, "
    "technician, CAST(scheduled_at AS TIMESTAMP) AS scheduled_at, "
    "CAST(nullif(completed_at, '') AS TIMESTAMP) AS completed_at FROM raw_jobs WHERE job_id IS NOT NULL)",
]

# ---------------------------------------------------------------------------
# marts, written from the definitions of their columns
# ---------------------------------------------------------------------------

_OUTCOMES = ("qualified", "booked", "escalated", "missed", "resolved")
_per_outcome = ", ".join(f"count(*) FILTER (WHERE outcome = {q(o)}) AS {o}" for o in _OUTCOMES)

MART_FUNNEL = [
    # jobs of each call, so that a call counts once however many jobs it has
    "per_call AS (SELECT related_call_id AS cid, count(*) AS jobs, count(*) FILTER (WHERE job_status = 'completed') AS done, "
    "count(*) FILTER (WHERE job_status = 'cancelled') AS off FROM stg_jobs GROUP BY related_call_id)",
    "funnel_days AS (SELECT call_timestamp::DATE AS call_date, count(*) AS total_calls, "
    f"{_per_outcome}, sum(duration_seconds) AS secs, count(duration_seconds) AS secs_n, "
    "sum(sentiment_x100) AS mood, count(sentiment_x100) AS mood_n, "
    "sum(jobs) AS jobs, sum(done) AS done, sum(off) AS off "
    "FROM stg_calls LEFT JOIN per_call ON cid = call_id GROUP BY ALL)",
    f"mart_call_funnel AS (SELECT call_date, total_calls, {', '.join(_OUTCOMES)}, "
    f"{hu('secs', 'secs_n', 1)} AS avg_duration_x10, {hu('mood', 'mood_n', 0)} AS avg_sentiment_x100, "
    + ", ".join(f"{hu(f'100 * {o}', 'total_calls', 1)} AS {n}_rate_x10"
                for o, n in (("booked", "booking"), ("escalated", "escalation"), ("missed", "miss")))
    + ", ifnull(jobs, 0)::BIGINT AS total_jobs, ifnull(done, 0)::BIGINT AS completed_jobs, "
    "ifnull(off, 0)::BIGINT AS cancelled_jobs FROM funnel_days)",
]

MART_REVENUE = [
    "takings AS (SELECT payment_timestamp::DATE AS payment_date, service_description, payment_method, amount_cents, "
    "CASE status WHEN 'refunded' THEN amount_cents ELSE 0 END AS back, status = 'refunded' AS refunded FROM stg_payments)",
    "mart_revenue AS (SELECT payment_date, service_description, payment_method, count(*) AS transaction_count, "
    f"sum(amount_cents) AS revenue_cents, {hu('sum(amount_cents)', 'count(amount_cents)', 2, 2)} AS avg_ticket_cents, "
    "count(*) FILTER (WHERE refunded) AS refund_count, sum(back) AS refund_cents, "
    "sum(amount_cents - back) AS net_cents FROM takings GROUP BY ALL)",
]

MART_JOBS = [
    "job_sums AS (SELECT service_category, count(*) AS total_jobs, "
    + ", ".join(f"count(*) FILTER (WHERE job_status = {q(x)}) AS {x}" for x in ("completed", "scheduled", "cancelled"))
    + ", sum(job_value_x100) FILTER (WHERE job_status = 'completed') AS total_completed_cents, "
    "count(job_value_x100) FILTER (WHERE job_status = 'completed') AS priced FROM stg_jobs GROUP BY service_category)",
    "mart_jobs AS (SELECT service_category, total_jobs, completed, scheduled, cancelled, total_completed_cents, "
    f"{hu('100 * completed', 'total_jobs', 1)} AS completion_rate_x10, "
    f"{hu('total_completed_cents', 'priced', 2, 2)} AS avg_completed_cents FROM job_sums)",
]


def base(marts: tuple[str, ...] = ("funnel", "revenue", "jobs"), loaded_at=None, damaged=False) -> list[str]:
    ctes = raw_ctes(loaded_at, damaged) + STG
    if "funnel" in marts:
        ctes += MART_FUNNEL
    if "revenue" in marts:
        ctes += MART_REVENUE
    if "jobs" in marts:
        ctes += MART_JOBS
    return ctes


FUNNEL_WIRE = (
    f"{d('call_date')} AS call_date, total_calls, qualified, booked, escalated, missed, resolved, "
    f"{dbl('avg_duration_x10', 1)} AS avg_duration_seconds, {dbl('avg_sentiment_x100', 2)} AS avg_sentiment, "
    f"{dbl('booking_rate_x10', 1)} AS booking_rate_pct, {dbl('escalation_rate_x10', 1)} AS escalation_rate_pct, "
    f"{dbl('miss_rate_x10', 1)} AS miss_rate_pct, total_jobs, completed_jobs, cancelled_jobs"
)

REVENUE_WIRE = (
    f"{d('payment_date')} AS payment_date, service_description, payment_method, transaction_count, "
    f"{dbl('revenue_cents', 2)} AS revenue_dollars, {dbl('avg_ticket_cents', 2)} AS avg_ticket_dollars, "
    f"refund_count, {dbl('refund_cents', 2)} AS refund_dollars, {dbl('net_cents', 2)} AS net_revenue_dollars"
)

JOBS_WIRE = (
    "service_category, total_jobs, completed, scheduled, cancelled, "
    f"{dbl('completion_rate_x10', 1)} AS completion_rate_pct, {dbl('avg_completed_cents', 2)} AS avg_completed_value, "
    f"{dbl('total_completed_cents', 2)} AS total_completed_value"
)


def b(x: str) -> str:
    """Sum of integers as BIGINT (DuckDB widens sums to HUGEINT)."""
    return f"CAST({x} AS BIGINT)"
