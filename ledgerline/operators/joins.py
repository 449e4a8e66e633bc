"""Call/job joins (JON-1..3).

Jobs are always reduced to one row per call id *before* they meet the calls,
so a call with many jobs (or one hot call id holding a third of all jobs) is
collapsed by the map-side partial aggregate instead of fanning out the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Parts the blank call id is spread over.
BLANK_PARTS = 64


def jobs_per_call(jobs: DataFrame) -> DataFrame:
    """One row per related call: job count, completed and cancelled counts."""
    j = F.col("job_id")
    return (
        jobs.where(F.col("related_call_id").isNotNull())
        .groupBy("related_call_id")
        .agg(
            F.count(j).alias("n_jobs"),
            F.count(F.when(F.col("job_status") == "completed", j)).alias("n_completed"),
            F.count(F.when(F.col("job_status") == "cancelled", j)).alias("n_cancelled"),
        )
    )


def calls_with_jobs(calls: DataFrame, jobs: DataFrame) -> DataFrame:
    """calls LEFT JOIN jobs-per-call; each call row keeps its own job counts.

    Calls without an id all carry the blank one, so they may be a large part of
    the table: the blank key is spread over ``BLANK_PARTS`` parts, and the one row
    of jobs with a blank id is repeated for each.
    """
    jpc = jobs_per_call(jobs)
    parts = F.when(F.col("related_call_id") == "", F.sequence(F.lit(0), F.lit(BLANK_PARTS - 1))).otherwise(F.array(F.lit(0)))
    jpc = jpc.withColumn("_job_part", F.explode(parts))
    spread = F.pmod(F.xxhash64(*calls.columns), F.lit(BLANK_PARTS)).cast("int")
    keyed = calls.withColumn("_call_part", F.when(F.col("call_id") == "", spread).otherwise(F.lit(0)))
    on = (F.col("call_id") == F.col("related_call_id")) & (F.col("_call_part") == F.col("_job_part"))
    return keyed.join(jpc, on, "left").drop("related_call_id", "_call_part", "_job_part")


def jobs_by_call_day(calls: DataFrame, jobs: DataFrame) -> DataFrame:
    """JON-1: per call date, jobs related to that day's calls."""
    cw = calls_with_jobs(calls.select("call_id", "call_timestamp"), jobs)
    return cw.groupBy(F.to_date("call_timestamp").alias("call_date")).agg(
        F.coalesce(F.sum("n_jobs"), F.lit(0)).alias("total_jobs"),
        F.coalesce(F.sum("n_completed"), F.lit(0)).alias("completed_jobs"),
        F.coalesce(F.sum("n_cancelled"), F.lit(0)).alias("cancelled_jobs"),
    )


def with_jobs(daily: DataFrame, jobs_agg: DataFrame) -> DataFrame:
    """JON-2: daily LEFT JOIN the per-day job counts, missing days as 0.

    Both sides are already one row per day (bounded by the calendar), so the
    join is between two small aggregates.
    """
    j = daily.join(jobs_agg, "call_date", "left")
    return j.select(
        *[F.col(c) for c in daily.columns],
        *[F.coalesce(F.col(c), F.lit(0)).alias(c)
          for c in ("total_jobs", "completed_jobs", "cancelled_jobs")],
    )


def call_job_mismatches(calls: DataFrame, jobs: DataFrame) -> DataFrame:
    """JON-3: referential consistency between booked calls and jobs.

    One row per reason with its count: booked calls without a job, jobs whose
    call is absent or not booked, calls with more than one job.

    Both sides are first reduced to one row per key with its multiplicity
    (map-side partial aggregates), so a key holding a third of the rows is
    collapsed before the shuffle. One full outer join of the two reduced
    sides (both already hash-partitioned on the key, so no further exchange)
    then answers all three questions in a single aggregate: an unmatched
    booked key is a call without a job, an unmatched job key (including the
    NULL group, which never matches) is a job without a booked call.
    """
    booked = (calls.where(F.col("outcome") == "booked").groupBy("call_id")
              .agg(F.count(F.lit(1)).alias("n_calls")))
    per_call = jobs.groupBy("related_call_id").agg(F.count(F.lit(1)).alias("n"))
    both = booked.join(per_call, booked.call_id == per_call.related_call_id, "full_outer")

    no_job = F.col("related_call_id").isNull() & F.col("n").isNull()
    no_call = F.col("call_id").isNull()
    several = F.col("related_call_id").isNotNull() & (F.col("n") > 1)
    zero = F.lit(0).cast("bigint")
    totals = both.agg(
        F.coalesce(F.sum(F.when(no_job, F.col("n_calls"))), zero).cast("bigint")
         .alias("booked_call_without_job"),
        F.coalesce(F.sum(F.when(no_call, F.col("n"))), zero).cast("bigint")
         .alias("job_without_booked_call"),
        F.count(F.when(several, 1)).cast("bigint").alias("call_with_several_jobs"),
    )
    return totals.unpivot(
        [], ["booked_call_without_job", "job_without_booked_call", "call_with_several_jobs"],
        "reason", "failures")
