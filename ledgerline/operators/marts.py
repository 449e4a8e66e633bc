"""Marts (AGG-1..5, SNK-6).

Every mart is a single grouped aggregate over its staging input with
conditional counts folded into one pass; averages and percentages are
rounded exactly (see ``functions.numeric``). Marts are tables, so they carry
no row order (a global sort would add a sampling job and a range shuffle to
every reader); the ordered views are the serving queries and
``ordered_mart``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.numeric import avg_half_up, pct
from ledgerline.operators.joins import calls_with_jobs
from ledgerline.schemas import MART_COLUMN_COMMENTS, MART_DESCRIPTIONS

OUTCOMES = ["qualified", "booked", "escalated", "missed", "resolved"]


def _outcome_counts():
    return [F.count(F.when(F.col("outcome") == o, 1)).alias(o) for o in OUTCOMES]


def _call_avgs():
    d = F.col("duration_seconds")
    s = F.col("sentiment_score")
    return [
        avg_half_up(F.sum(d), F.count(d), 1).alias("avg_duration_seconds"),
        avg_half_up(F.sum(s), F.count(s), 2, scale=2).alias("avg_sentiment"),
    ]


def call_funnel_counts(calls: DataFrame) -> DataFrame:
    """AGG-1: per call day: total, one count per outcome, rounded averages."""
    return calls.groupBy(F.to_date("call_timestamp").alias("call_date")).agg(
        F.count(F.lit(1)).alias("total_calls"), *_outcome_counts(), *_call_avgs())


def _with_rates(df: DataFrame) -> DataFrame:
    return df.select(
        "call_date", "total_calls", *OUTCOMES, "avg_duration_seconds", "avg_sentiment",
        pct(F.col("booked"), F.col("total_calls")).alias("booking_rate_pct"),
        pct(F.col("escalated"), F.col("total_calls")).alias("escalation_rate_pct"),
        pct(F.col("missed"), F.col("total_calls")).alias("miss_rate_pct"),
        "total_jobs", "completed_jobs", "cancelled_jobs",
    )


def mart_call_funnel(calls: DataFrame, jobs: DataFrame) -> DataFrame:
    """AGG-2 (flagship): daily funnel + rates + job counts.

    Plan: jobs are pre-aggregated per call id, left-joined once to the calls,
    and a single group-by on the call date computes both the funnel counts and
    the job counts. Same result as aggregating calls and call-joined jobs
    separately and joining the two per-day results, with one scan of the
    calls and one join instead of two scans and two joins.
    """
    cw = calls_with_jobs(
        calls.select("call_id", "call_timestamp", "outcome", "duration_seconds", "sentiment_score"),
        jobs.select("job_id", "related_call_id", "job_status"))
    daily = cw.groupBy(F.to_date("call_timestamp").alias("call_date")).agg(
        F.count(F.lit(1)).alias("total_calls"), *_outcome_counts(), *_call_avgs(),
        F.coalesce(F.sum("n_jobs"), F.lit(0)).alias("total_jobs"),
        F.coalesce(F.sum("n_completed"), F.lit(0)).alias("completed_jobs"),
        F.coalesce(F.sum("n_cancelled"), F.lit(0)).alias("cancelled_jobs"),
    )
    return _with_rates(daily)


def mart_revenue(payments: DataFrame) -> DataFrame:
    """AGG-3: per (day, service, method); gross includes refunds."""
    amt = F.col("amount_dollars")
    refunded = F.col("status") == "refunded"
    g = payments.groupBy(
        F.to_date("payment_timestamp").alias("payment_date"),
        "service_description", "payment_method",
    ).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum(amt).alias("revenue_dollars"),
        avg_half_up(F.sum(amt), F.count(amt), 2, scale=2).alias("avg_ticket_dollars"),
        F.count(F.when(refunded, 1)).alias("refund_count"),
        F.coalesce(F.sum(F.when(refunded, amt)), F.lit(0)).cast("decimal(28,2)").alias("refund_dollars"),
    )
    return g.select(
        "payment_date", "service_description", "payment_method", "transaction_count",
        "revenue_dollars", "avg_ticket_dollars", "refund_count", "refund_dollars",
        (F.col("revenue_dollars") - F.col("refund_dollars")).alias("net_revenue_dollars"),
    )


def mart_jobs(jobs: DataFrame) -> DataFrame:
    """AGG-4: per service category; ordered by completed value, NULLs first."""
    st = F.col("job_status")
    done_value = F.when(st == "completed", F.col("job_value"))
    completed = F.count(F.when(st == "completed", 1))
    return jobs.groupBy("service_category").agg(
        F.count(F.lit(1)).alias("total_jobs"),
        completed.alias("completed"),
        F.count(F.when(st == "scheduled", 1)).alias("scheduled"),
        F.count(F.when(st == "cancelled", 1)).alias("cancelled"),
        pct(completed, F.count(F.lit(1))).alias("completion_rate_pct"),
        avg_half_up(F.sum(done_value), F.count(done_value), 2, scale=2).alias("avg_completed_value"),
        F.sum(done_value).alias("total_completed_value"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """AGG-5: one row per source with its row count (one job, one union)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


MART_ORDER = {
    "mart_call_funnel": [("call_date", "asc")],
    "mart_revenue": [("payment_date", "asc"), ("service_description", "asc")],
    "mart_jobs": [("total_completed_value", "desc_nulls_first")],
}


def ordered_mart(df: DataFrame, name: str) -> DataFrame:
    """The mart in its documented order (NULLs first on a descending sort)."""
    return df.orderBy(*[getattr(F.col(c), how)() for c, how in MART_ORDER[name]])


MART_BUILDERS = {
    "mart_call_funnel": lambda stg: mart_call_funnel(stg["calls"], stg["jobs"]),
    "mart_revenue": lambda stg: mart_revenue(stg["payments"]),
    "mart_jobs": lambda stg: mart_jobs(stg["jobs"]),
}


def build_marts(stg):
    """Mart name -> DataFrame, each defined on first access."""
    from ledgerline.plans.lazy import LazyMap

    return LazyMap(MART_BUILDERS, lambda name: MART_BUILDERS[name](stg))


def with_comments(df: DataFrame, mart: str) -> DataFrame:
    """Attach the column documentation as StructField metadata comments."""
    comments = MART_COLUMN_COMMENTS.get(mart, {})
    return df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments
                       else F.col(c) for c in df.columns])


#: Date column of each dated mart; its month is the folder a written mart's rows lie in.
MART_DATES = {"mart_call_funnel": "call_date", "mart_revenue": "payment_date"}


def write_served(df: DataFrame, name: str) -> DataFrame:
    """Write a mart to a folder of its own below the shared folder and read it back; dated marts by month."""
    from ledgerline.functions.wire import MONTH
    from ledgerline.session import scratch_path

    spark, path = df.sparkSession, scratch_path(df.sparkSession, "served", name)
    schema = df.schema
    if name in MART_DATES:
        df = df.withColumn(MONTH, F.date_format(MART_DATES[name], "yyyy-MM"))
        schema = df.schema
        df.repartition(MONTH).write.partitionBy(MONTH).parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def write_mart(spark: SparkSession, df: DataFrame, name: str, database: str = "marts") -> DataFrame:
    """SNK-6: full replace of ``database.name`` as a catalog table (parquet),
    published by build-then-swap; dated marts lie in month folders, which date filters prune.

    Each run writes a new version folder under the table's folder; the
    catalog entry is pointed at it only after that write job has committed.
    A run that fails part-way (or whose driver is lost) leaves readers on the
    previous version instead of a dropped or half-written table. Versions
    younger than ``RETENTION`` are kept, committed or not: reads that started
    before the swap finish on theirs, and folders other runs are writing stay.
    """
    import uuid

    from ledgerline.functions.wire import MONTH
    from ledgerline.session import shared_warehouse

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    root = shared_warehouse(spark)
    table_dir = f"{root}/{database}.db/{name}"
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    version = f"{table_dir}/{VERSION_PREFIX}{stamp}-{uuid.uuid4().hex[:8]}"
    out = with_comments(df, name)
    if name in MART_DATES and MART_DATES[name] in out.columns:
        out = out.withColumn(MONTH, F.date_format(MART_DATES[name], "yyyy-MM"))
        writer = out.repartition(MONTH).write.partitionBy(MONTH)
    else:
        writer = out.write
    try:
        writer.mode("errorifexists").parquet(version)
    except Exception:
        _delete(spark, version)  # the table still points at the previous version
        raise

    full = f"{database}.{name}"
    same_layout = spark.catalog.tableExists(full) and (
        [(f.name, f.dataType) for f in spark.table(full).schema]
        == [(f.name, f.dataType) for f in out.schema])
    if same_layout:
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{version}'")
        spark.catalog.refreshTable(full)
    else:
        # first run, or the mart's columns changed: a new catalog entry (the
        # table is external, so dropping it keeps the files of older versions)
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.catalog.createTable(full, path=version, source="parquet", schema=out.schema,
                                  description=MART_DESCRIPTIONS.get(name, ""))
    remove_old_versions(spark, table_dir, current=version)
    return spark.table(full)


VERSION_PREFIX = "version-"
#: Age from which a version that is not the current one is removed; longer than any read or run.
RETENTION = dt.timedelta(hours=24)


def mart_versions(spark: SparkSession, table_dir: str) -> list[str]:
    """Version folders of a mart, oldest first (names sort by time)."""
    from ledgerline.sources.lake import _fs

    fs, p = _fs(spark, f"{table_dir}/{VERSION_PREFIX}*")
    statuses = fs.globStatus(p)
    return sorted(str(s.getPath()) for s in (statuses or []) if s.isDirectory())


def _delete(spark: SparkSession, path: str) -> None:
    from ledgerline.sources.lake import _fs

    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def remove_old_versions(spark: SparkSession, table_dir: str, current: str, now: dt.datetime | None = None) -> None:
    """Drop versions started more than ``RETENTION`` ago, never the current one."""
    now = now or dt.datetime.now(dt.timezone.utc)
    limit = VERSION_PREFIX + (now - RETENTION).strftime("%Y%m%dT%H%M%S%f")
    for v in mart_versions(spark, table_dir):
        name = v.rsplit("/", 1)[-1]
        if name < limit and name != current.rsplit("/", 1)[-1]:
            _delete(spark, v)
