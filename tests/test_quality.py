"""Data tests, gate, artifact roll-up and freshness cases."""

import datetime as dt
import json
import os
import tempfile

import pytest

from ledgerline.operators import quality as Q

AS_OF = dt.datetime(2024, 2, 1, 12, 0, 0)


def test_single_tests(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "bad"), (None, "bad2"), ("c", "bad")],
                               "id string, v string")
    assert Q.not_null(df, "id").first().failures == 1
    assert Q.unique(df, "id").first().failures == 1          # only 'a' is duplicated; NULL ignored
    assert Q.accepted_values(df, "v", ["x"]).first().failures == 2  # 'bad', 'bad2'; NULL ignored
    clean = spark.createDataFrame([("a",)], "id string")
    r = Q.unique(clean, "id").first()
    assert (r.column, r.test, r.failures) == ("id", "unique", 0)


def test_gate_propagates_two_levels(spark):
    res = spark.createDataFrame(
        [("raw", "raw.calls", "urgency", "accepted_values", 1, "fail"),
         ("raw", "raw.jobs", "job_id", "unique", 0, "pass"),
         ("staging", "stg_jobs", "job_id", "unique", 0, "pass")],
        "layer string, model string, column string, test string, failures long, status string")
    g = {r.model: r.status for r in Q.gate(res).collect()}
    assert g["raw.calls"] == "fail"
    assert g["stg_calls"] == "skip" and g["mart_call_funnel"] == "skip"
    assert g["mart_jobs"] == "pass" and g["stg_payments"] == "pass"


def test_status_counts_from_artifact(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    path = os.path.join(d, "run_results.json")
    with open(path, "w") as f:
        json.dump({"results": [{"status": "pass"}, {"status": "fail"}, {"status": "pass"},
                               {"status": "success"}, {"status": "skip"}], "elapsed_time": 1.5}, f)
    got = {r.status: r.n for r in Q.status_counts(Q.read_run_results(spark, path)).collect()}
    assert got == {"pass": 2, "fail": 1, "error": 0, "warn": 0, "skip": 1}
    missing = {r.status: r.n for r in Q.status_counts(Q.read_run_results(spark, d + "/nope.json")).collect()}
    assert missing == {s: 0 for s in Q.RESULT_STATUSES}


def _raw(spark, ages_hours):
    out = {}
    for name, h in ages_hours.items():
        if h is None:
            out[name] = spark.createDataFrame([], "id string, _loaded_at timestamp_ntz")
        else:
            out[name] = spark.createDataFrame([("1", AS_OF - dt.timedelta(hours=h))],
                                              "id string, _loaded_at timestamp_ntz")
    return out


@pytest.mark.parametrize("hours,status", [(1, "fresh"), (24, "fresh"), (30, "warn"), (48, "warn"),
                                          (50, "error")])
def test_freshness_bands(spark, hours, status):
    f = Q.freshness(_raw(spark, {"calls": hours}), AS_OF).first()
    assert f.status == status
    assert float(f.age_hours) == float(hours)


def test_verdict_messages(spark):
    v = Q.verdict(Q.freshness(_raw(spark, {"calls": 1}), AS_OF)).first()
    assert v.fresh and not v.warn and v.message is None
    v = Q.verdict(Q.freshness(_raw(spark, {"calls": 1, "payments": 30}), AS_OF)).first()
    assert v.fresh and v.warn and v.message.startswith("Note: ")
    assert "payments: data is 30h old (warn threshold is 24h)" in v.message
    v = Q.verdict(Q.freshness(_raw(spark, {"calls": 50, "payments": 30}), AS_OF)).first()
    assert not v.fresh and v.message.startswith("Cannot answer: data is stale. ")
    assert "calls: stale (50h old, threshold is 48h); payments: data is 30h old" in v.message
    f = Q.freshness(_raw(spark, {"calls": None}), AS_OF).first()
    assert f.status == "error" and f.age_hours is None and f.message == "calls: no data loaded"


def test_gated_refuses_and_caveats(spark):
    stale = Q.verdict(Q.freshness(_raw(spark, {"calls": 50}), AS_OF))
    r = Q.gated(stale, lambda: spark.range(3))
    assert r.error == "data_stale" and r.data is None
    warn = Q.verdict(Q.freshness(_raw(spark, {"calls": 30}), AS_OF))
    r = Q.gated(warn, lambda: spark.range(3))
    assert r.data.count() == 3 and r.caveat.startswith("Note: ")
    assert Q.gated_frame(stale, lambda: spark.range(3)).count() == 0


def test_a_table_that_cannot_be_read_is_an_error_of_its_tests_only(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators import quality as Q

    good = spark.range(3).select(F.col("id").cast("string").alias("a"))
    bad = spark.range(3).select(F.concat(F.lit("x"), F.col("id").cast("string")).cast("int").alias("a"))
    tests = [Q.DataTest("raw", "raw.calls", "a", "not_null"), Q.DataTest("raw", "raw.jobs", "a", "unique"), Q.DataTest("raw", "raw.jobs", "a", "not_null")]
    res = Q.run_suite_isolated({"raw.calls": good, "raw.jobs": bad}, tests)
    assert sorted((r.model, r.test, r.failures, r.status) for r in res.collect()) == [
        ("raw.calls", "not_null", 0, "pass"), ("raw.jobs", "not_null", None, "error"), ("raw.jobs", "unique", None, "error")]
    status = {r.model: r.status for r in Q.gate(res).collect()}
    assert status["raw.jobs"] == "fail" and status["stg_jobs"] == "skip" and status["mart_jobs"] == "skip" and status["stg_calls"] == "pass"


def test_artifacts_absent_unreadable_or_with_unknown_statuses(spark, tmp_path):
    from ledgerline.operators import quality as Q

    def counts(path):
        return {r.status: r.n for r in Q.status_counts(Q.read_run_results(spark, str(path))).collect()}

    zero = dict.fromkeys(Q.RESULT_STATUSES, 0)
    assert counts(tmp_path / "none.json") == zero
    (tmp_path / "bad.json").write_text("this is no JSON {")
    assert counts(tmp_path / "bad.json") == zero
    (tmp_path / "ok.json").write_text('{"results": [{"status": "pass"}, {"status": "odd"}, {"status": "error"}, {}], "elapsed_time": 1.5}')
    assert counts(tmp_path / "ok.json") == zero | {"pass": 1, "error": 1}
