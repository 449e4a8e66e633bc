"""Joins on tables bucketed by call id."""

import random

import pytest

from ledgerline.operators import bucketed, joins


def tables(spark, seed=1):
    """Calls and jobs with a third of them without an id, repeated ids and ids on one side only."""
    rng = random.Random(seed)
    calls = [("" if rng.random() < 0.33 else f"c{rng.randrange(300)}", f"2024-01-{1 + rng.randrange(28):02d} 10:00:00", rng.choice(["booked", "missed", "resolved"])) for _ in range(900)]
    jobs = [(f"j{i}", "" if rng.random() < 0.33 else f"c{rng.randrange(150, 450)}", rng.choice(["completed", "cancelled", "scheduled"])) for i in range(700)]
    return (spark.createDataFrame(calls, "call_id string, t string, outcome string").selectExpr("call_id", "cast(t as timestamp_ntz) as call_timestamp", "outcome"),
            spark.createDataFrame(jobs, "job_id string, related_call_id string, job_status string"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_same_rows_as_the_joins_with_a_shuffle(spark):
    calls, jobs = tables(spark)
    for name, (c, j) in {"all": (calls, jobs), "no_jobs": (calls, jobs.limit(0)), "no_calls": (calls.limit(0), jobs),
                         "blank_jobs": (calls.where("call_id <> ''"), jobs), "blank_calls": (calls, jobs.where("related_call_id <> ''"))}.items():
        bucketed.write_bucketed(c, j, f"bucketed_{name}", buckets=4)
        assert rows(bucketed.jobs_by_call_day(spark, f"bucketed_{name}")) == rows(joins.jobs_by_call_day(c, j)), name
        assert rows(bucketed.call_job_mismatches(spark, f"bucketed_{name}")) == rows(joins.call_job_mismatches(c, j)), name


def below_join(plan):
    """The lines of a formatted plan's tree that stand below its join."""
    tree = [ln for ln in plan.split("\n\n")[0].splitlines()]
    at = next(i for i, ln in enumerate(tree) if "Join" in ln)
    depth = len(tree[at]) - len(tree[at].lstrip(" :+-*"))
    return [ln for ln in tree[at + 1 :] if len(ln) - len(ln.lstrip(" :+-*")) > depth]


@pytest.mark.parametrize("query", ["jobs_by_call_day", "call_job_mismatches"])
def test_no_exchange_below_the_join(spark, query):
    calls, jobs = tables(spark)
    bucketed.write_bucketed(calls, jobs, "bucketed_plan", buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = getattr(bucketed, query)(spark, "bucketed_plan")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan or "Bucketed scan" in plan or "SelectedBucketsCount" in plan
    assert not any("Exchange" in ln for ln in below_join(plan)), plan


def test_a_bucket_is_one_file_and_blank_calls_are_spread(spark):
    calls, jobs = tables(spark)
    bucketed.write_bucketed(calls, jobs, "bucketed_files", buckets=4)
    assert len(spark.table("bucketed_files.calls_by_id").inputFiles()) <= 4
    parts = spark.table("bucketed_files.calls_by_id").where("call_id = ''").select(bucketed.PART).distinct().count()
    assert parts > 20
