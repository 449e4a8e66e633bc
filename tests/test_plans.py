"""Plan properties of every registered query: no cartesian products or
nested-loop joins, no Python evaluation, pruned scans, partial aggregation."""

import contextlib
import io

import pytest

from ledgerline.plans.registry import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN_NODES = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                   "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_or_python_nodes(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    for node in FORBIDDEN_NODES:
        assert node not in plan, f"{key}: {node}"


def test_revenue_scan_is_pruned(spark):
    plan = _plan(QUERIES["mart_revenue"](spark, SF_SMALL))
    li = [line for line in plan.splitlines() if line.startswith("ReadSchema: struct<l_")]
    assert li and all("l_orderkey" not in s and "l_quantity" not in s for s in li)
    assert "partial_sum" in plan


def test_funnel_pre_aggregates_jobs_before_the_join(spark):
    plan = _plan(QUERIES["mart_call_funnel"](spark, SF_SMALL))
    # jobs are reduced per call id (a HashAggregate) below the outer join
    join_at = plan.index("LeftOuter")
    assert "HashAggregate" in plan[join_at:]
    scans = [ln for ln in plan.splitlines() if ln.startswith("(") and "Scan parquet" in ln]
    assert len(scans) == 2  # events (calls), orders (jobs)


def test_request_log_scan_is_pruned(spark):
    plan = _plan(QUERIES["request_rate"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan  # only the window column is read


def test_consistency_is_one_join_of_reduced_sides(spark):
    plan = _plan(QUERIES["call_job_consistency"](spark, SF_SMALL)).split("\n\n")[0]
    # one full outer join answers all three reasons; no anti-join branch per reason
    assert plan.count("FullOuter") == 1 and "LeftAnti" not in plan
    joins = [ln for ln in plan.splitlines() if "Join" in ln]
    # the others are the inner joins that build the (damaged) jobs extract
    assert all("FullOuter" in ln or "Inner" in ln for ln in joins)


def test_serving_reads_written_marts(spark):
    for key in ("revenue_by_service", "hero_totals", "call_funnel_summary", "job_completion", "date_range", "call_funnel_range"):
        plan = _plan(QUERIES[key](spark, SF_SMALL))
        for table in ("lineitem", "events", "orders", "part.parquet"):
            assert f"/{table}" not in plan, f"{key} reads {table}"
    for key in ("date_range", "call_funnel_range", "revenue_summary_total"):
        plan = _plan(QUERIES[key](spark, SF_SMALL))
        assert "PartitionFilters: [isnotnull(_month" in plan, key


def test_quality_family_reads_one_result_table(spark):
    for key in ("dq_gate", "dq_status_counts", "alert_test_failure", "failed_test_total"):
        plan = _plan(QUERIES[key](spark, SF_SMALL))
        assert "lineitem" not in plan and "/raw/" not in plan, key


def test_blank_call_ids_are_spread(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators import joins

    calls = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "").otherwise(F.col("id").cast("string")).alias("call_id"),
        F.expr("timestampadd(MINUTE, id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("call_timestamp"))
    jobs = spark.createDataFrame([("a", "", "completed"), ("b", "", "cancelled"), ("c", "1", "completed"), ("d", None, "completed")],
                                 "job_id string, related_call_id string, job_status string")
    got = joins.calls_with_jobs(calls, jobs)
    assert got.count() == 900
    assert got.agg(F.sum("n_jobs")).first()[0] == 300 * 2 + 1
    keys = got.where("call_id = ''").select(F.pmod(F.xxhash64("call_id", "call_timestamp"), F.lit(joins.BLANK_PARTS))).distinct().count()
    assert keys > 20
    assert "_call_part" in _plan(got)


def test_damaged_payments_read_the_line_items_once(spark, tmp_path):
    """A second copy of each first line item (none where the number is null), from one scan and one join."""
    from ledgerline.sources.tables import damaged_payments_extract, payments_extract

    spark.sql("SELECT id AS l_orderkey, CAST(7 AS BIGINT) AS l_partkey, CAST(3 AS BIGINT) AS l_suppkey, CAST(IF(id = 5, null, id % 3) AS INT) AS l_linenumber, "
              "12.345D AS l_extendedprice, 'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP_NTZ'1995-01-01 00:00:00' AS l_shipdate "
              "FROM range(9)").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT CAST(7 AS BIGINT) AS p_partkey, 'tin' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    clean, damaged = payments_extract(spark, str(tmp_path)), damaged_payments_extract(spark, str(tmp_path))
    assert damaged.schema == clean.schema
    second = clean.where("payment_id in ('pi_1_1_7_3', 'pi_4_1_7_3', 'pi_7_1_7_3')")
    assert sorted(map(tuple, damaged.collect())) == sorted(map(tuple, clean.unionByName(second).collect()))
    scans = [ln for ln in _plan(damaged).splitlines() if ln.startswith("(") and "Scan parquet" in ln]
    assert len(scans) == 2  # lineitem, part
