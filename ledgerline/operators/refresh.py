"""Incremental marts (AGG-2..4, SNK-6): a load changes the months it touches and nothing else.

A mart row keeps, beside its published columns, the sums and counts they are
rounded from. Such rows merge by addition, so a load is aggregated on its own, added
to the stored rows of the months it touches, and only those month folders are
written anew. Jobs meet calls of earlier loads (and calls jobs): what the
funnel needs for that is kept as two narrow tables that only grow, the day of each
call and the jobs of each call id. Marts and both tables are committed as one version
of a snapshot store, together with the name of the load, so a load that is
repeated after a crash counts once and two loads at a time cannot miss each other.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.numeric import avg_half_up, pct
from ledgerline.functions.wire import MONTH
from ledgerline.operators.joins import BLANK_PARTS, jobs_per_call
from ledgerline.operators.marts import OUTCOMES
from ledgerline.operators.staging import staging
from ledgerline.plans.pipeline import materialize
from ledgerline.schemas import MART_COLUMN_COMMENTS
from ledgerline.sources.snapshots import WHOLE, WRITER, Snapshot, SnapshotStore, Transaction

FUNNEL_SUMS = ["total_calls", *OUTCOMES, "total_jobs", "completed_jobs", "cancelled_jobs", "duration_sum", "duration_count", "sentiment_sum", "sentiment_count"]
FUNNEL_SCHEMA = T.StructType([T.StructField("call_date", T.DateType()), *[T.StructField(c, T.DecimalType(13, 2) if c == "sentiment_sum" else T.LongType()) for c in FUNNEL_SUMS]])
REVENUE_KEYS = ["payment_date", "service_description", "payment_method"]
REVENUE_SUMS = ["transaction_count", "revenue_dollars", "ticket_count", "refund_count", "refund_dollars"]
JOB_SUMS = ["total_jobs", "completed", "scheduled", "cancelled", "total_completed_value", "priced"]
#: Columns of a stored mart row that are kept for merging and not published.
HIDDEN = {"mart_call_funnel": ["duration_sum", "duration_count", "sentiment_sum", "sentiment_count"],
          "mart_revenue": ["ticket_count"], "mart_jobs": ["priced"]}
#: Narrow tables that only grow: the day of each call, the jobs of each call id.
CALL_DAYS, CALL_JOBS = "call_days", "call_jobs"
#: Grows by a row for each load that is in.
LOADS = "loads"


def _merged(rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Rows with equal keys added up, each sum in its column's type (null where nothing was summed)."""
    kinds = {f.name: f.dataType for f in rows.schema}
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in sums])


# One load on its own: sums and counts only.

def revenue_sums(payments: DataFrame) -> DataFrame:
    amount, refunded = F.col("amount_dollars"), F.col("status") == "refunded"
    return payments.groupBy(F.to_date("payment_timestamp").alias("payment_date"), "service_description", "payment_method").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum(amount).alias("revenue_dollars"), F.count(amount).alias("ticket_count"),
        F.count(F.when(refunded, 1)).alias("refund_count"), F.coalesce(F.sum(F.when(refunded, amount)), F.lit(0)).cast("decimal(28,2)").alias("refund_dollars"))


def job_sums(jobs: DataFrame) -> DataFrame:
    status = F.col("job_status")
    value = F.when(status == "completed", F.col("job_value"))
    return jobs.groupBy("service_category").agg(
        F.count(F.lit(1)).alias("total_jobs"), *[F.count(F.when(status == s, 1)).alias(s) for s in ("completed", "scheduled", "cancelled")],
        F.sum(value).alias("total_completed_value"), F.count(value).alias("priced"))


def call_sums(calls: DataFrame) -> DataFrame:
    """Per call day what the calls alone give; job counts are 0."""
    d, s = F.col("duration_seconds"), F.col("sentiment_score")
    per_day = calls.groupBy(F.to_date("call_timestamp").alias("call_date")).agg(
        F.count(F.lit(1)).alias("total_calls"), *[F.count(F.when(F.col("outcome") == o, 1)).alias(o) for o in OUTCOMES],
        F.sum(d).alias("duration_sum"), F.count(d).alias("duration_count"), F.sum(s).alias("sentiment_sum"), F.count(s).alias("sentiment_count"))
    return per_day.select(*[(F.col(f.name) if f.name in per_day.columns else F.lit(0)).cast(f.dataType).alias(f.name) for f in FUNNEL_SCHEMA])


def day_of_calls(calls: DataFrame) -> DataFrame:
    """(call_id, call_date, calls): a row per call id and day."""
    return calls.groupBy("call_id", F.to_date("call_timestamp").alias("call_date")).agg(F.count(F.lit(1)).alias("calls"))


def jobs_of_days(days: DataFrame, jobs: DataFrame) -> DataFrame:
    """Job counts per call day, in the columns of ``call_sums``: ``days`` (call_id, call_date, calls) met by
    ``jobs`` (related_call_id, n_jobs, n_completed, n_cancelled). Both have a row per id and load, so
    what a load adds is a sum over pairs of rows. The blank id, which many calls may carry, is a row a day
    and load by then; its days are spread over parts. Both sides grow with the calls, so neither is sent to
    the driver: files of ids compress so well that by their size they would pass for small tables."""
    parts = F.when(F.col("related_call_id") == "", F.sequence(F.lit(0), F.lit(BLANK_PARTS - 1))).otherwise(F.array(F.lit(0)))
    at = F.when(F.col("call_id") == "", F.pmod(F.hash("call_date"), F.lit(BLANK_PARTS))).otherwise(F.lit(0))
    met = days.withColumn("_at", at).join(jobs.withColumn("_part", F.explode(parts)).hint("merge"), (F.col("call_id") == F.col("related_call_id")) & (F.col("_at") == F.col("_part")))
    counts = met.groupBy("call_date").agg(*[F.sum(F.col(c) * F.col("calls")).alias(n) for c, n in
                                            (("n_jobs", "total_jobs"), ("n_completed", "completed_jobs"), ("n_cancelled", "cancelled_jobs"))])
    return counts.select(*[F.col(f.name) if f.name in counts.columns else F.lit(None if f.name in ("duration_sum", "sentiment_sum") else 0).cast(f.dataType).alias(f.name)
                           for f in FUNNEL_SCHEMA])


# Published columns from sums.

def finish_revenue(sums: DataFrame) -> DataFrame:
    return sums.select(
        *REVENUE_KEYS, "transaction_count", "revenue_dollars", avg_half_up(F.col("revenue_dollars"), F.col("ticket_count"), 2, scale=2).alias("avg_ticket_dollars"),
        "refund_count", "refund_dollars", (F.col("revenue_dollars") - F.col("refund_dollars")).alias("net_revenue_dollars"), "ticket_count")


def finish_funnel(sums: DataFrame) -> DataFrame:
    return sums.select(
        "call_date", "total_calls", *OUTCOMES, avg_half_up(F.col("duration_sum"), F.col("duration_count"), 1).alias("avg_duration_seconds"),
        avg_half_up(F.col("sentiment_sum"), F.col("sentiment_count"), 2, scale=2).alias("avg_sentiment"),
        *[pct(F.col(c), F.col("total_calls")).alias(f"{n}_rate_pct") for c, n in (("booked", "booking"), ("escalated", "escalation"), ("missed", "miss"))],
        "total_jobs", "completed_jobs", "cancelled_jobs", *HIDDEN["mart_call_funnel"])


def finish_jobs(sums: DataFrame) -> DataFrame:
    return sums.select(
        "service_category", "total_jobs", "completed", "scheduled", "cancelled", pct(F.col("completed"), F.col("total_jobs")).alias("completion_rate_pct"),
        avg_half_up(F.col("total_completed_value"), F.col("priced"), 2, scale=2).alias("avg_completed_value"), "total_completed_value", "priced")


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def _folder(month: str | None) -> str:
    return f"{MONTH}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}"


def _by_month(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their month, dealt so that a month's folder gets few files and a large month several tasks."""
    return rows.withColumn(MONTH, month_of(F.col(keys[0]))).repartition(MONTH, *keys[-1:])


def _refresh_dated(tx: Transaction, name: str, delta: DataFrame, keys: list[str], sums: list[str], finish: Callable[[DataFrame], DataFrame]) -> None:
    """Add ``delta`` to the stored rows of the months it touches, and write those months."""
    delta = materialize(tx.store.spark, {name: delta})[name]
    months = [_folder(r[0]) for r in delta.select(month_of(F.col(keys[0]))).distinct().collect()]  # a row for each month
    rows = delta.select(*keys, *sums)
    if not tx.has(name):
        tx.replace(name, _by_month(finish(rows), keys), MONTH)
    elif months:
        rows = rows.unionByName(tx.read(name, months).select(*keys, *sums))
        tx.replace_parts(name, _by_month(finish(_merged(rows, keys, sums)), keys), MONTH, months)


def apply_load(store: SnapshotStore, load: str, raw: Mapping[str, DataFrame]) -> Snapshot:
    """Bring one load (its new raw rows per source; a source may be missing) into the marts.

    A load that is in already changes nothing. Each mart's folders of months that the
    load does not touch stay as they are. Returns the version that has the load.
    """
    stg = staging(raw)

    def work(tx: Transaction) -> None:
        if tx.knows(LOADS, load):
            return
        if "payments" in stg:
            _refresh_dated(tx, "mart_revenue", revenue_sums(stg["payments"]), REVENUE_KEYS, REVENUE_SUMS, finish_revenue)
        if "jobs" in stg:
            rows = job_sums(stg["jobs"])
            if tx.has("mart_jobs"):
                rows = rows.unionByName(tx.read("mart_jobs").select(rows.columns))
            tx.replace("mart_jobs", finish_jobs(_merged(rows, ["service_category"], JOB_SUMS)))
        funnel = []
        if "calls" in stg:  # new calls with the jobs of all loads
            tx.append(CALL_DAYS, day_of_calls(stg["calls"]), load)
            funnel.append(call_sums(stg["calls"]))
            if tx.has(CALL_JOBS):
                funnel.append(jobs_of_days(tx.staged(CALL_DAYS), tx.read(CALL_JOBS)))
        if "jobs" in stg:  # new jobs with the calls of earlier loads, and with those of this one
            tx.append(CALL_JOBS, jobs_per_call(stg["jobs"].select("job_id", "related_call_id", "job_status")), load)
            if tx.has(CALL_DAYS):
                funnel.append(jobs_of_days(tx.read(CALL_DAYS), tx.staged(CALL_JOBS)))
            if "calls" in stg:
                funnel.append(jobs_of_days(tx.staged(CALL_DAYS), tx.staged(CALL_JOBS)))
        if funnel:
            delta = _merged(reduce(DataFrame.unionByName, funnel), ["call_date"], FUNNEL_SUMS)
            _refresh_dated(tx, "mart_call_funnel", delta, ["call_date"], FUNNEL_SUMS, finish_funnel)
        tx.append(LOADS, store.spark.range(1).select(F.lit(load).alias("load")), load)
        tx.info = {"load": load}

    return store.update(work, f"load {load}")


def rebuild(store: SnapshotStore, raw: Mapping[str, DataFrame], load: str = "full") -> Snapshot:
    """All tables anew from complete raw tables, as one version (a load that stands for all before it)."""
    stg = staging(raw)

    def work(tx: Transaction) -> None:
        for table in tx.base.parts:
            tx.read(table)
        tx.replace(CALL_DAYS, day_of_calls(stg["calls"]))
        tx.replace(CALL_JOBS, jobs_per_call(stg["jobs"].select("job_id", "related_call_id", "job_status")))
        days = call_sums(stg["calls"]).unionByName(jobs_of_days(tx.staged(CALL_DAYS), tx.staged(CALL_JOBS)))
        tx.replace("mart_call_funnel", _by_month(finish_funnel(_merged(days, ["call_date"], FUNNEL_SUMS)), ["call_date"]), MONTH)
        tx.replace("mart_revenue", _by_month(finish_revenue(revenue_sums(stg["payments"])), REVENUE_KEYS), MONTH)
        tx.replace("mart_jobs", finish_jobs(job_sums(stg["jobs"])))
        tx.replace(LOADS, store.spark.range(1).select(F.lit(load).alias("load")))
        tx.info = {"load": load}

    return store.update(work, f"rebuild {load}")


def read_mart(store: SnapshotStore, name: str, snapshot: Snapshot | None = None, months: Iterable[str] | None = None) -> DataFrame:
    """A mart as it is published; with ``months`` (yyyy-MM) only their folders are read."""
    snapshot = snapshot or store.snapshot()
    rows = store.frame(snapshot, name, None if months is None else [_folder(m) for m in months])
    return rows.drop(*HIDDEN[name], MONTH)


def publish_snapshot(store: SnapshotStore, snapshot: Snapshot, database: str) -> None:
    """Point the catalog tables ``database.mart_*`` at the folders of a version, month by month.

    Entries follow the log and may be set again at any time; a reader that needs all
    marts of one version takes them from the store, by a pin.
    """
    spark: SparkSession = store.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, hidden in HIDDEN.items():
        if name not in snapshot.parts:
            continue
        full, comments, folder = f"{database}.{name}", MART_COLUMN_COMMENTS.get(name, {}), f"{store.root}/data/{name}"
        fields = [f for f in T.StructType.fromJson(json.loads(snapshot.schemas[name])) if f.name not in hidden]
        kept = spark.catalog.tableExists(full) and [(f.name, f.dataType) for f in spark.table(full).schema] == [(f.name, f.dataType) for f in fields]
        dated = snapshot.columns[name] is not None
        place = folder if dated else f"{folder}/{WRITER}={snapshot.parts[name][WHOLE]}"
        if not kept:
            spark.sql(f"DROP TABLE IF EXISTS {full}")  # external: the files stay
            quoted = {f.name: comments.get(f.name, "").replace("'", "\\'") for f in fields}
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()} COMMENT '{quoted[f.name]}'" for f in fields)
            spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet {f'PARTITIONED BY (`{MONTH}`)' if dated else ''} LOCATION '{place}'")
        if not dated:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{place}'")
        else:
            there = {r[0] for r in spark.sql(f"SHOW PARTITIONS {full}").collect()}  # a row for each month
            for part, writer in snapshot.parts[name].items():
                spec, at = f"(`{MONTH}`='{part.split('=', 1)[1]}')", f"'{folder}/{WRITER}={writer}/{part}'"
                spark.sql(f"ALTER TABLE {full} PARTITION {spec} SET LOCATION {at}" if part in there else f"ALTER TABLE {full} ADD PARTITION {spec} LOCATION {at}")
            for part in there - set(snapshot.parts[name]):
                spark.sql(f"ALTER TABLE {full} DROP PARTITION (`{MONTH}`='{part.split('=', 1)[1]}')")
        spark.catalog.refreshTable(full)
