"""The operational extracts projected from the benchmark tables: counts,
fields, text-only raw layout, determinism and referential consistency."""

from pyspark.sql import functions as F

from ledgerline.operators import joins
from ledgerline.plans.pipeline import layers
from ledgerline.schemas import SOURCES
from ledgerline.sources.tables import extracts, read_table
from tests.conftest import SF_CHECK, SF_SMALL


def test_counts_follow_the_tables(spark):
    ex = extracts(spark, SF_SMALL)
    events = read_table(spark, SF_SMALL, "events")
    assert ex["calls"].count() == events.count()
    assert ex["payments"].count() == read_table(spark, SF_SMALL, "lineitem").count()
    assert ex["jobs"].count() == read_table(spark, SF_SMALL, "orders").count()


def test_raw_layout_is_text_and_never_null(spark):
    lay = layers(spark, SF_SMALL)
    for name, cols in SOURCES.items():
        raw = lay.raw[name]
        assert raw.columns == cols + ["_loaded_at"]
        assert all(t == "string" for c, t in raw.dtypes if c != "_loaded_at")
        nulls = raw.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
        assert all(v == 0 for v in nulls)


def test_payment_ids_unique_at_check_scale(spark):
    pay = extracts(spark, SF_CHECK)["payments"]
    assert pay.select("payment_id").distinct().count() == pay.count()


def test_deterministic(spark):
    a = extracts(spark, SF_SMALL)["jobs"].orderBy("job_id").collect()
    b = extracts(spark, SF_SMALL)["jobs"].orderBy("job_id").collect()
    assert a == b


def test_call_job_mismatches_are_found(spark):
    stg = layers(spark, SF_SMALL).staging
    booked = {r.call_id for r in stg["calls"].where("outcome = 'booked'").select("call_id").collect()}
    calls = [r.related_call_id for r in stg["jobs"].select("related_call_id").collect()]
    got = {r.reason: r.failures for r in joins.call_job_mismatches(stg["calls"], stg["jobs"]).collect()}
    assert got == {"booked_call_without_job": len(booked - set(calls)), "job_without_booked_call": sum(c not in booked for c in calls),
                   "call_with_several_jobs": 0}
    damaged = layers(spark, SF_SMALL, damaged=True).staging
    got = {r.reason: r.failures for r in joins.call_job_mismatches(damaged["calls"], damaged["jobs"]).collect()}
    assert got["call_with_several_jobs"] > 0
