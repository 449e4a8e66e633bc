"""Calls and jobs kept together by call id (JON-1, JON-3 without a shuffle).

Both tables are written once into the same number of buckets of the call id, sorted
within each, so every join of the two and every grouping by call id afterwards reads bucket
against bucket. Jobs are reduced to a row per call id before they are written. The
blank id, which a large part of the calls may carry, is cut into parts by a hash of
the call; its one row of jobs stands in every part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.joins import BLANK_PARTS
from ledgerline.session import shared_warehouse

BUCKETS = 32
PART = "_part"


def write_bucketed(calls: DataFrame, jobs: DataFrame, database: str, buckets: int = BUCKETS) -> None:
    """Write ``calls_by_id`` and ``jobs_by_id`` of staging calls and jobs into ``database``, published by
    pointing the catalog at new folders once both are written."""
    spark = calls.sparkSession
    root = f"{shared_warehouse(spark)}/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    status, job = F.col("job_status"), F.col("job_id")
    per_call = jobs.where("related_call_id is not null").groupBy(F.col("related_call_id").alias("call_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(job).alias("n_jobs"), F.count(F.when(status == "completed", job)).alias("n_completed"), F.count(F.when(status == "cancelled", job)).alias("n_cancelled"))
    parts = F.when(F.col("call_id") == "", F.sequence(F.lit(0), F.lit(BLANK_PARTS - 1))).otherwise(F.array(F.lit(0)))
    rows = {"jobs_by_id": per_call.withColumn(PART, F.explode(parts)),
            "calls_by_id": calls.withColumn(PART, F.when(F.col("call_id") == "", F.pmod(F.xxhash64(*calls.columns), F.lit(BLANK_PARTS)).cast("int")).otherwise(F.lit(0)))}
    for name, df in rows.items():
        # Dealt as the buckets are, each bucket is one file; without it every task would write to all.
        dealt = df.repartition(buckets, "call_id", PART)
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")  # external: files that others still read stay
        (dealt.write.bucketBy(buckets, "call_id", PART).sortBy("call_id", PART)
         .option("path", f"{root}/{name}/{uuid.uuid4().hex}").saveAsTable(f"{database}.{name}"))


def _sides(spark: SparkSession, database: str) -> tuple[DataFrame, DataFrame]:
    return spark.table(f"{database}.calls_by_id"), spark.table(f"{database}.jobs_by_id")


def jobs_by_call_day(spark: SparkSession, database: str) -> DataFrame:
    """JON-1 on the bucketed tables: per call date, jobs related to that day's calls."""
    calls, jobs = _sides(spark, database)
    met = calls.select("call_id", PART, "call_timestamp").join(jobs, ["call_id", PART], "left")
    return met.groupBy(F.to_date("call_timestamp").alias("call_date")).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("n_jobs", "total_jobs"), ("n_completed", "completed_jobs"), ("n_cancelled", "cancelled_jobs"))])


def call_job_mismatches(spark: SparkSession, database: str) -> DataFrame:
    """JON-3 on the bucketed tables: one row per reason with its count.

    Booked calls are counted per id and part in their bucket and met by the jobs in the
    same bucket. The parts of the blank id are one id: its calls and jobs are put
    together from the few rows that carry them.
    """
    calls, jobs = _sides(spark, database)
    booked = calls.where("outcome = 'booked'").groupBy("call_id", PART).agg(F.count(F.lit(1)).alias("n_calls"))
    both = booked.join(jobs.select("call_id", PART, "n_rows"), ["call_id", PART], "full_outer")
    blank, zero = F.col("call_id") == "", F.lit(0).cast("long")

    def total(condition, value):
        return F.coalesce(F.sum(F.when(condition, value)), zero)

    sums = both.agg(
        total(~blank & F.col("n_rows").isNull(), F.col("n_calls")).alias("call_alone"),
        total(~blank & F.col("n_calls").isNull(), F.col("n_rows")).alias("job_alone"),
        F.count(F.when(~blank & (F.col("n_rows") > 1), 1)).alias("several"),
        total(blank, F.col("n_calls")).alias("blank_calls"),
        F.coalesce(F.max(F.when(blank, F.col("n_rows"))), zero).alias("blank_jobs"))
    return sums.select(
        (F.col("call_alone") + F.when(F.col("blank_jobs") == 0, F.col("blank_calls")).otherwise(zero)).alias("booked_call_without_job"),
        (F.col("job_alone") + F.when(F.col("blank_calls") == 0, F.col("blank_jobs")).otherwise(zero)).alias("job_without_booked_call"),
        (F.col("several") + F.when(F.col("blank_jobs") > 1, 1).otherwise(0)).alias("call_with_several_jobs"),
    ).unpivot([], ["booked_call_without_job", "job_without_booked_call", "call_with_several_jobs"], "reason", "failures")
