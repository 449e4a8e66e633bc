"""Data-quality tests, gate and freshness (DQ-1..9).

A test returns failing rows; we report their count. Null and value tests of a table
and of the staging view over it are one grouped pass (rows fall together by their
values outside the lists, which nearly all rows have none of); unique tests are one
grouping by the column for both. A hot value (one id holding a third of the rows) is
collapsed by the partial aggregate.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.numeric import half_up_div
from ledgerline.schemas import (
    JOB_STATUS_VALUES,
    LOADED_AT,
    OUTCOME_VALUES,
    PAYMENT_STATUS_VALUES,
    URGENCY_VALUES,
)


@dataclass(frozen=True)
class DataTest:
    layer: str
    model: str
    column: str
    test: str  # not_null | unique | accepted_values
    values: tuple[str, ...] = field(default=())


def _nn(layer, model, col):
    return DataTest(layer, model, col, "not_null")


def _uq(layer, model, col):
    return DataTest(layer, model, col, "unique")


def _av(layer, model, col, values):
    return DataTest(layer, model, col, "accepted_values", tuple(values))


# The declared suite: 13 source tests, 14 staging tests, 8 mart tests.
DEFAULT_SUITE: list[DataTest] = [
    _nn("raw", "raw.calls", "call_id"), _uq("raw", "raw.calls", "call_id"),
    _nn("raw", "raw.calls", "timestamp"),
    _av("raw", "raw.calls", "urgency", URGENCY_VALUES), _av("raw", "raw.calls", "outcome", OUTCOME_VALUES),
    _nn("raw", "raw.payments", "payment_id"), _uq("raw", "raw.payments", "payment_id"),
    _nn("raw", "raw.payments", "timestamp"), _av("raw", "raw.payments", "status", PAYMENT_STATUS_VALUES),
    _nn("raw", "raw.jobs", "job_id"), _uq("raw", "raw.jobs", "job_id"),
    _nn("raw", "raw.jobs", "related_call_id"), _av("raw", "raw.jobs", "status", JOB_STATUS_VALUES),
    _nn("staging", "stg_calls", "call_id"), _uq("staging", "stg_calls", "call_id"),
    _nn("staging", "stg_calls", "call_timestamp"),
    _av("staging", "stg_calls", "urgency", URGENCY_VALUES),
    _av("staging", "stg_calls", "outcome", OUTCOME_VALUES),
    _nn("staging", "stg_payments", "payment_id"), _uq("staging", "stg_payments", "payment_id"),
    _nn("staging", "stg_payments", "amount_cents"),
    _nn("staging", "stg_jobs", "job_id"), _uq("staging", "stg_jobs", "job_id"),
    _nn("staging", "stg_jobs", "related_call_id"), _uq("staging", "stg_jobs", "related_call_id"),
    _av("staging", "stg_jobs", "job_status", JOB_STATUS_VALUES), _nn("staging", "stg_jobs", "job_value"),
    _nn("marts", "mart_call_funnel", "call_date"), _uq("marts", "mart_call_funnel", "call_date"),
    _nn("marts", "mart_call_funnel", "total_calls"),
    _nn("marts", "mart_revenue", "payment_date"), _nn("marts", "mart_revenue", "revenue_dollars"),
    _nn("marts", "mart_jobs", "service_category"), _uq("marts", "mart_jobs", "service_category"),
    _nn("marts", "mart_jobs", "total_jobs"),
]

# Model lineage (parent -> child) used by the gate.
LINEAGE = [
    ("raw.calls", "stg_calls"), ("raw.payments", "stg_payments"), ("raw.jobs", "stg_jobs"),
    ("stg_calls", "mart_call_funnel"), ("stg_jobs", "mart_call_funnel"),
    ("stg_payments", "mart_revenue"), ("stg_jobs", "mart_jobs"),
]
MODELS = ["raw.calls", "raw.payments", "raw.jobs", "stg_calls", "stg_payments", "stg_jobs",
          "mart_call_funnel", "mart_revenue", "mart_jobs"]

# Result statuses counted in the run artifact.
RESULT_STATUSES = ["pass", "fail", "error", "warn", "skip"]


def layer_tables(raw, stg, marts):
    """Model name -> table over all layers (tables defined on first access)."""
    from ledgerline.plans.lazy import LazyMap

    where = {f"raw.{k}": (raw, k) for k in raw}
    where.update({f"stg_{k}": (stg, k) for k in stg})
    where.update({k: (marts, k) for k in marts})
    return LazyMap(where, lambda m: where[m][0][where[m][1]])


#: View model -> (base model, row condition, column expressions).
Views = Mapping[str, tuple[str, Column, dict[str, Column]]]


def tests_by_base(tests: list[DataTest], views: Views) -> dict[str, list[tuple[int, DataTest]]]:
    """Base table -> the numbered tests on it and on views over it."""
    out: dict[str, list[tuple[int, DataTest]]] = {}
    for i, t in enumerate(tests):
        out.setdefault(views[t.model][0] if t.model in views else t.model, []).append((i, t))
    return out


def _column(t: DataTest, views: Views) -> tuple[Column, Column]:
    """The tested value of a base row, and whether the row belongs to the tested model."""
    if t.model in views:
        _, keep, columns = views[t.model]
        return columns[t.column], F.coalesce(keep, F.lit(False))
    return F.col(f"`{t.column}`"), F.lit(True)


def odd_values(rows: DataFrame, tests: list[tuple[int, DataTest]], views: Views) -> DataFrame:
    """(tid, value, n) of a base table: nulls of each not_null test (value ''), and rows with each value
    outside the list of an accepted_values test. One pass: rows are grouped by their
    odd values (none for nearly all rows), with the null counts beside them."""
    odd = []
    for i, t in tests:
        value, keep = _column(t, views)
        if t.test == "accepted_values":
            odd.append(F.when(keep & ~value.cast("string").isin(list(t.values)), value.cast("string")).alias(f"v{i}"))
    nulls = [(i, *_column(t, views)) for i, t in tests if t.test == "not_null"]
    groups = rows.groupBy(*odd).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(keep & value.isNull()).alias(f"n{i}") for i, value, keep in nulls])
    pairs = [F.struct(F.lit(i).alias("tid"), F.col(f"v{i}").alias("value"), F.col("n")) for i, t in tests if t.test == "accepted_values"]
    pairs += [F.struct(F.lit(i).alias("tid"), F.lit("").alias("value"), F.col(f"n{i}").alias("n")) for i, *_ in nulls]
    flat = groups.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("value is not null and n > 0")
    return flat.groupBy("tid", "value").agg(F.sum("n").alias("n"))


def key_tests(tests: list[DataTest], views: Views) -> dict[str, list[tuple[int, DataTest]]]:
    """Name of a key -> the unique tests on it (of the base table and of views that take the column over)."""
    out: dict[str, list[tuple[int, DataTest]]] = {}
    for i, t in enumerate(tests):
        if t.test == "unique":
            base = views[t.model][0] if t.model in views else t.model
            out.setdefault(f"{base}_{t.column}".replace(".", "_"), []).append((i, t))
    return out


def unique_base(own: list[tuple[int, DataTest]], views: Views) -> str:
    model = own[0][1].model
    return views[model][0] if model in views else model


def key_counts(rows: DataFrame, tests: list[tuple[int, DataTest]], views: Views) -> DataFrame:
    """(key, n0, n1, ...): rows of each key, for each of the tests on it; one grouping for all of them."""
    value, _ = _column(tests[0][1], views)
    counts = [F.count_if(_column(t, views)[1] & _column(t, views)[0].isNotNull()).alias(f"n{i}") for i, t in tests]
    return rows.groupBy(value.cast("string").alias("key")).agg(*counts).where("key is not null")


def suite_frame(spark: SparkSession, tests: list[DataTest], views: Views, values: list[DataFrame], keys: Mapping[str, DataFrame]) -> DataFrame:
    """(layer, model, column, test, failures, status) from odd values and key counts; what is absent passes."""
    schema = "tid int, layer string, model string, column string, test string"
    meta = spark.createDataFrame([(i, t.layer, t.model, t.column, t.test) for i, t in enumerate(tests)], schema)
    found = []
    if values:
        per_test = reduce(DataFrame.unionByName, values).groupBy("tid").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"))
        found.append(per_test.join(meta.select("tid", "test"), "tid").select("tid", F.when(F.col("test") == "not_null", F.col("rows")).otherwise(F.col("values")).alias("failures")))
    for name, own in key_tests(tests, views).items():
        if name in keys:
            twice = keys[name].agg(*[F.count_if(F.col(f"n{i}") > 1).alias(str(i)) for i, _ in own])
            found.append(twice.unpivot([], [str(i) for i, _ in own], "tid", "failures").select(F.col("tid").cast("int").alias("tid"), "failures"))
    failures = F.coalesce(F.col("failures"), F.lit(0)).cast("bigint")
    rows = meta.join(reduce(DataFrame.unionByName, found), "tid", "left") if found else meta.withColumn("failures", F.lit(0))
    return rows.select("layer", "model", "column", "test", failures.alias("failures"), F.when(failures > 0, "fail").otherwise("pass").alias("status"))


def run_suite(tables: dict[str, DataFrame], tests: list[DataTest], views: Views | None = None) -> DataFrame:
    """DQ-4: rows (layer, model, column, test, failures, status).

    ``views`` (model -> (base model, condition, columns)) lets tests on a view
    run inside the scan of its base table: with staging defined over raw, null and
    value tests of both are one pass over the source, and the unique tests on a
    column of both one grouping by it.
    """
    spark = next(iter(tables.values())).sparkSession
    views = {m: v for m, v in (views or {}).items() if v[0] in tables}
    values = [odd_values(tables[base], own, views) for base, own in tests_by_base(tests, views).items() if any(t.test != "unique" for _, t in own)]
    keys = {name: key_counts(tables[unique_base(own, views)], own, views) for name, own in key_tests(tests, views).items()}
    return suite_frame(spark, tests, views, values, keys)


def run_suite_isolated(tables: dict[str, DataFrame], tests: list[DataTest],
                       views: dict[str, tuple[str, Column, dict[str, Column]]] | None = None) -> DataFrame:
    """DQ-4 with results computed now, source by source: if a table cannot be
    evaluated (a cast that fails, a file that is gone), its tests have status
    ``error`` and no failure count, and all other tests still run.
    """
    spark = next(iter(tables.values())).sparkSession
    views = views or {}
    by_scan: dict[str, list[DataTest]] = {}
    for t in tests:
        base = views.get(t.model)
        by_scan.setdefault(base[0] if base is not None and base[0] in tables else t.model, []).append(t)
    schema = "layer string, model string, column string, test string, failures bigint, status string"
    rows = []
    for own in by_scan.values():
        try:
            rows += [tuple(r) for r in run_suite(tables, own, views).collect()]  # a row per declared test
        except Exception as e:
            if not _from_spark(e):
                raise
            rows += [(t.layer, t.model, t.column, t.test, None, "error") for t in own]
    return spark.createDataFrame(rows, schema)


def _from_spark(e: Exception) -> bool:
    """Whether an error came out of running a job or resolving a table, not out of our own code."""
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    return isinstance(e, (PySparkException, Py4JJavaError))


def single_test(df: DataFrame, test: DataTest) -> DataFrame:
    """DQ-1..3: one row (column, test, failures), never empty."""
    r = run_suite({test.model: df}, [test])
    return r.select("column", "test", "failures")


def not_null(df: DataFrame, col: str) -> DataFrame:
    return single_test(df, DataTest("", "t", col, "not_null"))


def unique(df: DataFrame, col: str) -> DataFrame:
    return single_test(df, DataTest("", "t", col, "unique"))


def accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    return single_test(df, DataTest("", "t", col, "accepted_values", tuple(values)))


def gate(results: DataFrame, edges: list[tuple[str, str]] | None = None,
         models: list[str] | None = None) -> DataFrame:
    """DQ-5: a failing test skips every downstream model (depth 2 lineage).

    status: ``skip`` if any ancestor has a failing test (or one that could not
    run), else ``fail`` if the model's own tests fail, else ``pass``.
    """
    spark = results.sparkSession
    edges = edges or LINEAGE
    models = models or MODELS
    e = spark.createDataFrame(edges, "parent string, child string")
    m = spark.createDataFrame([(x,) for x in models], "model string")
    failed = results.groupBy("model").agg(F.max(F.col("status").isin("fail", "error")).alias("failed"))
    e2 = (e.alias("a").join(e.alias("b"), F.col("a.child") == F.col("b.parent"))
          .select(F.col("a.parent").alias("parent"), F.col("b.child").alias("child")))
    anc = e.unionByName(e2).distinct()
    bad_parent = (anc.join(failed.where("failed").withColumnRenamed("model", "parent"), "parent")
                  .select(F.col("child").alias("model")).distinct().withColumn("upstream_failed", F.lit(True)))
    return (m.join(failed, "model", "left").join(bad_parent, "model", "left")
            .select("model", F.when(F.col("upstream_failed"), "skip")
                    .when(F.col("failed"), "fail").otherwise("pass").alias("status")))


def artifact_statuses(results: DataFrame, gate_status: DataFrame) -> DataFrame:
    """Per-test status as the run artifact records it: tests of skipped
    models are ``skip``."""
    g = gate_status.withColumnRenamed("status", "model_status")
    return results.join(g, "model", "left").select(
        "model", "column", "test",
        F.when(F.col("model_status") == "skip", "skip").otherwise(F.col("status")).alias("status"))


def status_counts(statuses: DataFrame) -> DataFrame:
    """DQ-6: counts for pass/fail/error/warn/skip, zero-filled; other
    statuses ignored. Input: any DataFrame with a ``status`` column."""
    spark = statuses.sparkSession
    dim = spark.createDataFrame([(i, s) for i, s in enumerate(RESULT_STATUSES)], "ord int, status string")
    c = statuses.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return (dim.join(c, "status", "left")
            .select("status", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"), "ord")
            .orderBy("ord").drop("ord"))


RUN_RESULTS_SCHEMA = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([T.StructField("status", T.StringType())]))),
    T.StructField("elapsed_time", T.DoubleType()),
])


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """Statuses from run artifacts ``{results: [{status}], elapsed_time}``.

    A missing artifact, or one that is no such JSON, yields no statuses (all counts zero)."""
    from ledgerline.sources.lake import path_exists

    if not path_exists(spark, path):
        return spark.createDataFrame([], "status string")
    # permissive: text that is not JSON reads as a row of nulls
    df = spark.read.schema(RUN_RESULTS_SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return df.select(F.explode_outer("results").alias("r")).select("r.status").where("status IS NOT NULL")


# ---------------------------------------------------------------------------
# freshness (DQ-7..9)
# ---------------------------------------------------------------------------

WARN_HOURS = 24
ERROR_HOURS = 48
_US_PER_HOUR = 3_600_000_000


def _hours_0f(us: Column) -> Column:
    """``{hours:.0f}``: half-to-even on the exact hour count."""
    return F.bround(us.cast("decimal(38,0)") / F.lit(_US_PER_HOUR), 0).cast("bigint").cast("string")


def freshness(raw: dict[str, DataFrame], as_of) -> DataFrame:
    """DQ-7: per source max(_loaded_at), age in hours @1dp, status, message."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    parts = None
    for i, name in enumerate(raw):
        p = raw[name].agg(F.max(LOADED_AT).alias("last_loaded")).select(
            F.lit(i).alias("ord"), F.lit(name).alias("source"), "last_loaded")
        parts = p if parts is None else parts.unionByName(p)
    us = F.expr(f"timestampdiff(MICROSECOND, last_loaded, TIMESTAMP_NTZ '{as_of.isoformat(sep=' ')}')")
    status = (F.when(F.col("last_loaded").isNull(), "error")
              .when(us > ERROR_HOURS * _US_PER_HOUR, "error")
              .when(us > WARN_HOURS * _US_PER_HOUR, "warn").otherwise("fresh"))
    # Message texts.
    msg = (F.when(F.col("last_loaded").isNull(), F.concat(F.col("source"), F.lit(": no data loaded")))
           .when(us > ERROR_HOURS * _US_PER_HOUR,
                 F.concat(F.col("source"), F.lit(": stale ("), _hours_0f(us),
                          F.lit(f"h old, threshold is {ERROR_HOURS}h)")))
           .when(us > WARN_HOURS * _US_PER_HOUR,
                 F.concat(F.col("source"), F.lit(": data is "), _hours_0f(us),
                          F.lit(f"h old (warn threshold is {WARN_HOURS}h)"))))
    return parts.select(
        "ord", "source", "last_loaded",
        half_up_div(us, F.lit(_US_PER_HOUR), 1).alias("age_hours"),
        status.alias("status"), msg.alias("message"),
    )


def verdict(fresh: DataFrame) -> DataFrame:
    """DQ-8: one row (fresh, warn, message); messages joined in source order."""
    msgs = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.when(F.col("message").isNotNull(),
                                           F.struct("ord", "message")))),
        lambda x: x["message"]), "; ")
    any_error = F.max(F.col("status") == "error")
    any_warn = F.max(F.col("status") == "warn")
    return fresh.agg(any_error.alias("e"), any_warn.alias("w"), msgs.alias("m")).select(
        (~F.col("e")).alias("fresh"),
        F.col("w").alias("warn"),
        F.when(F.col("e"), F.concat(F.lit("Cannot answer: data is stale. "), F.col("m"),
                                    F.lit(". Please run the pipeline before querying.")))
         .when(F.col("w"), F.concat(F.lit("Note: "), F.col("m"),
                                    F.lit(". Answers reflect data as of those times.")))
         .alias("message"),
    )


@dataclass
class Result:
    """Answer envelope: data (a DataFrame, never collected here) or an error."""
    data: DataFrame | None = None
    error: str | None = None
    message: str | None = None
    caveat: str | None = None
    sql: str | None = None
    row_count: int | None = None


def gated(verdict_df: DataFrame, build) -> Result:
    """DQ-9: refuse on a stale source, attach the caveat on warn.

    The verdict is one row; it is read once per answer and reused.
    """
    v = verdict_df.first()
    if v is None or not v["fresh"]:
        return Result(error="data_stale", message=v["message"] if v else "no verdict")
    return Result(data=build(), caveat=v["message"] if v["warn"] else None)


def gated_frame(verdict_df: DataFrame, build) -> DataFrame:
    """DQ-9 as one DataFrame: the answer with its caveat column, or no rows
    (with the answer's schema) when the gate refuses."""
    r = gated(verdict_df, build)
    if r.error:
        df = build()
        return df.limit(0).withColumn("caveat", F.lit(r.message))
    return r.data.withColumn("caveat", F.lit(r.caveat).cast("string"))
