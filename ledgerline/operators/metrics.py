"""Pipeline and request metrics with alert conditions (OBS-1..10).

The reference declares these as dashboard / alert expressions over scraped
samples; here they are DataFrame operators over a sample table and a request
log. Rates are counted exactly in tumbling windows (no counter extrapolation).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.timeutil import ntz_lit

# Request-duration histogram bucket upper bounds (ms); +Inf last.
LATENCY_BOUNDS_MS = [0, 5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000]
QUANTILES = [0.5, 0.95, 0.99]

# Dashboard threshold steps (value >= step -> colour).
BANDS = {
    "run_seconds": [(30, "yellow"), (120, "red")],
    "age_seconds": [(86400, "yellow"), (172800, "red")],
    "latency_ms": [(200, "yellow"), (1000, "red")],
    "error_ratio": [(0.05, "red")],
    "failed_tests": [(1, "red")],
}

FRESHNESS_BREACH_SECONDS = 172800
ALERT_FOR_SECONDS = 300
EVAL_INTERVAL_SECONDS = 60


# ---------------------------------------------------------------------------
# pipeline samples (OBS-1..5, 10)
# ---------------------------------------------------------------------------

def pipeline_metrics(rows: DataFrame, statuses: DataFrame, duration_seconds: float,
                     ts: dt.datetime) -> DataFrame:
    """OBS-1: long-form gauges (ts, metric, label, value) for one run.

    ``rows``: (source, rows) from AGG-5; ``statuses``: (status, n) from DQ-6.
    """
    t = ntz_lit(ts)
    spark = rows.sparkSession
    scalars = spark.createDataFrame(
        [("pipeline_run_duration_seconds", "", float(duration_seconds)),
         ("pipeline_last_success_timestamp", "",
          float(ts.replace(tzinfo=dt.timezone.utc).timestamp()))],
        "metric string, label string, value double")
    r = rows.select(F.lit("pipeline_rows_loaded").alias("metric"), F.col("source").alias("label"),
                    F.col("rows").cast("double").alias("value"))
    s = statuses.select(F.lit("pipeline_test_results").alias("metric"), F.col("status").alias("label"),
                        F.col("n").cast("double").alias("value"))
    return scalars.unionByName(r).unionByName(s).select(t.alias("ts"), "metric", "label", "value")


def success_samples(stg: dict[str, DataFrame]) -> DataFrame:
    """Times of successful pipeline runs (pipeline, t), one per source and data day on which it ran.

    A source runs on every second day with data, not on every fourteenth, some
    minutes after midnight; so some gaps exceed two days by a minute or two and
    others by days.
    """
    ts_col = {"calls": "call_timestamp", "payments": "payment_timestamp", "jobs": "scheduled_at"}
    out = None
    for name, df in stg.items():
        days = df.select(F.datediff(F.to_date(ts_col[name]), F.lit(dt.date(1970, 1, 1))).alias("d")).distinct()
        days = days.where((F.col("d") % 2 == 0) & (F.col("d") % 14 != 0))
        t = F.expr("timestampadd(MINUTE, CAST(d AS BIGINT) * 1440 + d % 7, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
        p = days.select(F.lit(name).alias("pipeline"), t.alias("t"))
        out = p if out is None else out.unionByName(p)
    return out


def daily_load_samples(stg: dict[str, DataFrame]) -> DataFrame:
    """Row-count samples of daily loads, one per source and data day
    (ts = end of the day): a sample series whose size follows the data."""
    ts_col = {"calls": "call_timestamp", "payments": "payment_timestamp", "jobs": "scheduled_at"}
    out = None
    for name, df in stg.items():
        day = F.to_date(ts_col[name])
        p = (df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).cast("double").alias("value"))
             .select((F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("ts"),
                     F.lit("pipeline_rows_loaded").alias("metric"), F.lit(name).alias("label"), "value"))
        out = p if out is None else out.unionByName(p)
    return out


def last_values(samples: DataFrame) -> DataFrame:
    """OBS-2: last non-null value per (metric, label)."""
    return (samples.where(F.col("value").isNotNull()).groupBy("metric", "label")
            .agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value")))


def band(df: DataFrame, col: str, steps: list[tuple[float, str]], base: str = "green",
         out: str = "band") -> DataFrame:
    """OBS-3: threshold colour: the highest step with value >= step."""
    c = F.col(col)
    expr = F.lit(base)
    for threshold, colour in steps:
        expr = F.when(c >= F.lit(threshold), F.lit(colour)).otherwise(expr)
    return df.withColumn(out, F.when(c.isNull(), F.lit(None)).otherwise(expr))


def band_all(values: DataFrame) -> DataFrame:
    """OBS-3 for all panels: ``values`` (metric, label, value) with the colour that each metric's own steps give
    (no value, or a metric without steps: null)."""
    colour = F.lit(None).cast("string")
    for metric, steps in BANDS.items():
        own = F.lit("green")
        for threshold, name in steps:
            own = F.when(F.col("value") >= F.lit(threshold), F.lit(name)).otherwise(own)
        colour = F.when(F.col("metric") == metric, own).otherwise(colour)
    return values.withColumn("band", F.when(F.col("value").isNotNull(), colour))


def alert_islands(evals: DataFrame, key: str, ts: str, cond: str,
                  for_seconds: int = ALERT_FOR_SECONDS) -> DataFrame:
    """Gaps-and-islands over an evaluation series: maximal runs of consecutive
    evaluations where ``cond`` holds; an island fires once it has held for
    ``for_seconds``. The series is per key and sized by the evaluation
    cadence (not by data volume), so the per-key window stays bounded.
    """
    w = Window.partitionBy(key).orderBy(ts)
    flagged = evals.select(key, ts, F.col(cond).alias("c")).withColumn(
        "brk", F.when(F.col("c") != F.coalesce(F.lag("c").over(w), ~F.col("c")), 1).otherwise(0))
    grp = flagged.withColumn("island", F.sum("brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    isl = grp.where("c").groupBy(key, "island").agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"))
    held = F.expr(f"timestampdiff(SECOND, start, `end`)")
    return isl.select(
        key, "start", "end", held.alias("held_seconds"),
        (held >= for_seconds).alias("fired"),
        F.when(held >= for_seconds, F.col("start") + F.make_dt_interval(secs=F.lit(for_seconds)))
         .alias("fired_at"),
    ).drop("island")


def freshness_breaches(arrivals: DataFrame, key: str, ts: str, as_of: dt.datetime,
                       threshold_seconds: int = FRESHNESS_BREACH_SECONDS,
                       for_seconds: int = ALERT_FOR_SECONDS,
                       eval_seconds: int = EVAL_INTERVAL_SECONDS) -> DataFrame:
    """OBS-4: ``now - last_success > threshold`` held for ``for_seconds``,
    evaluated every ``eval_seconds`` on an epoch-aligned grid up to ``as_of``.

    The condition can only hold between two consecutive arrivals more than
    ``threshold`` apart (or after the last one). Gaps inside a bucket of time no
    longer than the threshold never breach it, so arrivals are first reduced
    map-side to (first, last) per bucket, and only the series of buckets
    (bounded by the calendar) is ordered. Arrivals after ``as_of`` are not known
    yet and are left out.
    Output: one row per breach island with its first and last true
    evaluation, how long it held, and whether / when the alert fired.
    """
    a = arrivals.select(key, F.col(ts).cast("timestamp_ntz").alias("t")).where(F.col("t").isNotNull())
    # epoch micros of the wall-clock value (no session time zone involved)
    a = a.select(key, F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', t)").alias("u"))
    div = lambda x, y: F.call_function("div", x, F.lit(y))  # noqa: E731  exact integer division
    as_of_u = int(as_of.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    bucket = max(1, min(86_400, threshold_seconds)) * 1_000_000
    days = a.where(F.col("u") <= as_of_u).groupBy(key, div(F.col("u"), bucket).alias("bucket")).agg(
        F.min("u").alias("first_u"), F.max("u").alias("last_u"))
    w = Window.partitionBy(key).orderBy("bucket")
    g = eval_seconds * 1_000_000
    gaps = days.select(
        key, F.col("last_u").alias("a"),
        F.lead("first_u").over(w).alias("b"),
    )
    thr = threshold_seconds * 1_000_000
    # first evaluation strictly after a + threshold; last one before the next
    # arrival (or at as_of for the trailing gap)
    t1 = (div(F.col("a") + F.lit(thr), g) + 1) * F.lit(g)
    t2 = F.when(F.col("b").isNotNull(), (div(F.col("b") + F.lit(g - 1), g) - 1) * F.lit(g)) \
          .otherwise(F.lit(as_of_u // g * g))
    isl = gaps.select(key, t1.alias("t1"), t2.alias("t2")).where(F.col("t2") >= F.col("t1"))
    held = div(F.col("t2") - F.col("t1"), 1_000_000)
    to_ts = lambda c: F.expr(f"timestampadd(MICROSECOND, {c}, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    return isl.select(
        key, to_ts("t1").alias("start"), to_ts("t2").alias("end"), held.alias("held_seconds"),
        (held >= for_seconds).alias("fired"),
        F.when(held >= for_seconds, to_ts(f"t1 + {for_seconds * 1_000_000}")).alias("fired_at"),
    )


def test_alerts(status_counts: DataFrame) -> DataFrame:
    """OBS-5: one alert per status in {fail, error} with a count above 0."""
    return (status_counts.where(F.col("status").isin("fail", "error") & (F.col("n") > 0))
            .select(F.lit("PipelineTestFailure").alias("alert"), "status", "n"))


def failed_tests(status_counts: DataFrame) -> DataFrame:
    """OBS-10: total of test results with status fail or error."""
    return status_counts.agg(
        F.coalesce(F.sum(F.when(F.col("status").rlike("^(fail|error)$"), F.col("n"))), F.lit(0))
        .cast("bigint").alias("failed_tests"))


# ---------------------------------------------------------------------------
# request log (OBS-6..9)
# ---------------------------------------------------------------------------

def request_log(events: DataFrame) -> DataFrame:
    """Request log projection of the events table: ts, endpoint, status,
    duration_ms."""
    return events.select(
        F.col("ts"),
        F.concat(F.lit("/api/"), F.col("event_type")).alias("endpoint"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        # a request that was cut off has no duration
        F.when(F.col("event_id") % 40 != 0, F.col("value")).alias("duration_ms"),
    )


def _window(ts: str, size: str) -> Column:
    return F.window(ts, size)


def request_rate(log: DataFrame, size: str = "1 minute", seconds: int = 60) -> DataFrame:
    """OBS-6: requests per second in tumbling windows."""
    return log.groupBy(_window("ts", size).alias("w")).agg(F.count(F.lit(1)).alias("requests")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests",
        (F.col("requests") / F.lit(seconds)).alias("rps"))


def _bucket_index(c: Column, bounds: list[float]) -> Column:
    """Index of the first bound >= value (len(bounds) for +Inf)."""
    expr = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        expr = F.when(c <= F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return expr


def latency_quantiles(log: DataFrame, bounds: list[float] | None = None,
                      qs: list[float] | None = None, size: str = "5 minutes") -> DataFrame:
    """OBS-7: quantiles per window from cumulative ``le`` buckets, linear
    interpolation inside the bucket (first bucket starts at 0; a rank in
    +Inf returns the largest finite bound). Requests without a duration are not
    observations.

    Plan: bucket counts per (window, bucket) via a partial aggregate, then a
    cumulative sum over at most len(bounds)+1 rows per window.
    """
    bounds = [float(b) for b in (bounds or LATENCY_BOUNDS_MS)]
    qs = qs or QUANTILES
    counts = log.where(F.col("duration_ms").isNotNull()).groupBy(_window("ts", size).alias("w"),
                         _bucket_index(F.col("duration_ms"), bounds).alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("w").orderBy("b")
    cum = counts.withColumn("cum", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    cum = cum.withColumn("prev_cum", F.col("cum") - F.col("n"))
    hi = F.element_at(F.array(*[F.lit(b) for b in bounds], F.lit(None).cast("double")), F.col("b") + 1)
    lo = F.when(F.col("b") == 0, F.lit(0.0)).otherwise(
        F.element_at(F.array(*[F.lit(b) for b in bounds]), F.col("b")))
    total = F.max("cum").over(Window.partitionBy("w"))
    rows = cum.select("w", "n", "cum", "prev_cum", lo.alias("lo"), hi.alias("hi"), total.alias("total"))
    aggs = [F.max("total").alias("total")]
    for q in qs:
        rank = F.lit(q) * F.col("total")
        # the first bucket whose cumulative count reaches the rank
        first = (F.col("prev_cum") < rank) & (F.col("cum") >= rank)
        interp = F.col("lo") + (F.col("hi") - F.col("lo")) * ((rank - F.col("prev_cum")) / F.col("n"))
        val = F.when(F.col("hi").isNull(), F.lit(bounds[-1])).otherwise(interp)
        aggs.append(F.max(F.when(first, val)).alias(f"p{int(round(q * 100))}"))
    return rows.groupBy("w").agg(*aggs).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total",
        *[f"p{int(round(q * 100))}" for q in qs])


def error_ratio(log: DataFrame, size: str = "5 minutes") -> DataFrame:
    """OBS-8: share of 5xx responses per window."""
    is5xx = F.col("status").cast("string").rlike("^5..$")
    return log.groupBy(_window("ts", size).alias("w")).agg(
        F.count_if(is5xx).alias("errors"), F.count(F.lit(1)).alias("requests")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "errors", "requests",
        (F.col("errors") / F.col("requests")).alias("error_ratio"))


def requests_by_endpoint(log: DataFrame, size: str = "1 hour") -> DataFrame:
    """OBS-9: requests per endpoint per window."""
    return log.groupBy(_window("ts", size).alias("w"), "endpoint").agg(
        F.count(F.lit(1)).alias("requests")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "endpoint", "requests")
