"""Every tool under the gate, with rows and time in its audit line."""

import json

from pyspark.sql import functions as F

from ledgerline.operators import guard, serving
from ledgerline.operators.tools import Tools, read_audit
from ledgerline.plans.registry import _published, _served
from ledgerline.session import scratch_path
from tests.conftest import SF_SMALL

VERDICT = "fresh boolean, warn boolean, message string"


def tools(spark, fresh, warn, message, path=None, **marts):
    names = ("mart_call_funnel", "mart_revenue", "mart_jobs")
    return Tools(spark, {n: _served(spark, SF_SMALL, n) for n in names} | marts, spark.createDataFrame([(fresh, warn, message)], VERDICT), path, "tools")


def asked(t):
    return [t.revenue_summary(), t.revenue_summary("1998-01-01", "1998-12-31", "service"), t.revenue_summary(group_by="date"), t.call_funnel("2024-01-08"),
            t.job_completion(), t.job_completion("no such"), t.query_marts("SELECT * FROM marts.mart_jobs", seconds=60)]


def test_answers_equal_the_queries_and_count_their_rows(spark):
    _published(spark, SF_SMALL, ("mart_jobs",), "tools")
    path = scratch_path(spark, "audit")
    answers = asked(tools(spark, True, True, "Note: old", path))
    assert [a.row_count for a in answers] == [a.data.count() for a in answers] and answers[5].row_count == 0
    assert all(a.caveat == "Note: old" and a.error is None for a in answers)
    want = serving.revenue_summary(_served(spark, SF_SMALL, "mart_revenue"), None, None, "date")
    assert [r[0] for r in answers[2].data.orderBy("payment_date").select("transaction_count").collect()] == [r[0] for r in want.select("transaction_count").collect()]
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(lines) == 7 and all(x["duration_ms"] >= 0 and "timestamp" in x for x in lines)
    assert sorted(x["row_count"] for x in lines) == sorted(a.row_count for a in answers)


def test_stale_sources_refuse_every_tool(spark):
    path = scratch_path(spark, "audit")
    answers = asked(tools(spark, False, False, "stale", path))
    assert all((a.error, a.message, a.data) == ("data_stale", "stale", None) for a in answers)
    audit = read_audit(spark, path).collect()
    assert len(audit) == 7 and all(r.rejected and r.reason == "stale" and r.row_count is None and r.timed for r in audit)
    empty = Tools(spark, {}, spark.createDataFrame([], VERDICT))
    assert empty.call_funnel().error == "data_stale"


def test_a_failing_answer_is_logged_and_says_nothing(spark):
    path = scratch_path(spark, "audit")
    bad = _served(spark, SF_SMALL, "mart_jobs").withColumn("service_category", F.concat(F.lit("x"), "service_category").cast("int").cast("string"))
    r = tools(spark, True, False, None, path, mart_jobs=bad).job_completion()
    assert (r.error, r.message, r.data) == ("query_failed", guard.GENERIC_ERROR, None)
    line = json.loads(spark.read.text(path).first().value)
    assert "CAST_INVALID_INPUT" in line["error"] and line["tool"] == "job_completion" and "row_count" not in line
