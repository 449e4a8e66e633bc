"""The answering tools: every one gated, counted and logged (DQ-9, SQL-5, QRY-6..10).

An answer is computed once: while it is written, an observation counts its rows, and the
written rows are what is handed out. One verdict on the sources' age holds for all
answers of a conversation: stale sources refuse them, ageing ones add a caveat.
Every request leaves a line, whether it was answered, refused or failed.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.wire import to_wire
from ledgerline.operators import guard, serving
from ledgerline.operators.quality import Result


class Tools:
    """Tools over ``marts`` (name -> DataFrame), under one ``verdict`` (fresh, warn, message)."""

    def __init__(self, spark: SparkSession, marts: Mapping[str, DataFrame], verdict: DataFrame, audit_path: str | None = None, database: str = "marts"):
        row = verdict.first()
        self.spark, self.marts, self.audit_path, self.database = spark, marts, audit_path, database
        self.stale = None if row is not None and row["fresh"] else (row["message"] if row is not None else "no verdict")
        self.caveat = row["message"] if row is not None and row["warn"] else None

    def _answer(self, tool: str, given: dict, build: Callable[[], DataFrame]) -> Result:
        from ledgerline.session import scratch_path

        start = time.time()

        def log(**what) -> None:
            guard.log_request(self.spark, self.audit_path, tool, input=given, **what, duration_ms=int((time.time() - start) * 1000))

        if self.stale is not None:
            log(rejected=True, reason=self.stale)
            return Result(error="data_stale", message=self.stale)
        path, seen = scratch_path(self.spark, "answers", tool), Observation()
        try:
            answer = to_wire(build())
            answer.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        except Exception as e:
            log(error=f"{type(e).__name__}: {str(e)[:500]}")
            return Result(error="query_failed", message=guard.GENERIC_ERROR)
        rows = int(seen.get["rows"])
        log(row_count=rows)
        return Result(data=self.spark.read.schema(answer.schema).parquet(path), caveat=self.caveat, row_count=rows)

    def revenue_summary(self, date_from=None, date_to=None, group_by: str | None = None) -> Result:
        return self._answer("revenue_summary", {"date_from": date_from, "date_to": date_to, "group_by": group_by},
                            lambda: serving.revenue_summary(self.marts["mart_revenue"], date_from, date_to, group_by))

    def call_funnel(self, date_from=None, date_to=None) -> Result:
        return self._answer("call_funnel", {"date_from": date_from, "date_to": date_to},
                            lambda: serving.call_funnel_range(self.marts["mart_call_funnel"], date_from, date_to))

    def job_completion(self, category: str | None = None) -> Result:
        return self._answer("job_completion", {"category": category}, lambda: serving.job_completion(self.marts["mart_jobs"], category))

    def query_marts(self, sql: str, seconds: float = guard.STATEMENT_SECONDS) -> Result:
        """An ad-hoc SELECT; logged by the guard itself, which also vets it."""
        if self.stale is not None:
            return self._answer("query_marts", {"sql": sql}, lambda: self.marts["mart_jobs"])
        result = guard.guarded_query(self.spark, sql, None, self.audit_path, seconds, self.database)
        result.caveat = None if result.error else self.caveat
        return result


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """(tool, input, row_count, rejected, reason, timed) of the lines of an audit folder; ``input`` as JSON
    text of the non-null arguments in order of their names, ``timed`` whether a line has its milliseconds."""
    line = F.from_json("value", "tool string, input map<string,string>, input_sql string, row_count long, rejected boolean, reason string, error string, duration_ms long")
    rows = spark.read.text(path).select(line.alias("l")).select("l.*")
    entries = F.array_sort(F.map_entries(F.map_filter("input", lambda _, v: v.isNotNull())))
    given = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", ")
    return rows.select("tool", F.coalesce(given, F.concat(F.lit("sql="), F.col("input_sql"))).alias("input"), "row_count", F.coalesce("rejected", F.lit(False)).alias("rejected"),
                       F.col("reason"), F.coalesce(F.col("duration_ms") >= 0, F.lit(False)).alias("timed"))
