"""Request metrics from what a metric store holds (OBS-6..9): counters that only grow until a
restart, and sketches of durations that merge.

Counter samples are cumulative, so a window's increase is last - first plus what was
lost at each reset in between, carried on to the window's edges as the usual
``increase()`` and ``rate()`` do. Duration sketches are kept per minute and merged to any coarser
window without reading the log again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = ["endpoint", "status"]
#: Seconds after which the sampled process restarts and its counters begin at 0.
RESTART_SECONDS = 26_400
#: A gap to the window's edge of more than EDGE times the mean distance of samples is not bridged but by half of it.
EDGE = 1.1
#: Size of a duration sketch; its rank error is below RANK_ERROR for it.
SKETCH_K = 200
RANK_ERROR = 0.0265
QUANTILES = (0.5, 0.95, 0.99)


def _seconds(column: str) -> Column:
    """Seconds of a wall-clock time since 1970."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {column})")


def counter_samples(log: DataFrame, restart: int = RESTART_SECONDS) -> DataFrame:
    """(endpoint, status, t, value): each series' counter at the end of every minute with requests; t in seconds.

    Requests are counted by minute first, so the running sum orders at most the minutes
    between two restarts of a series.
    """
    minute = F.floor(_seconds("ts") / 60)
    per_minute = log.groupBy(*SERIES, minute.alias("m")).agg(F.count(F.lit(1)).alias("n"))
    t = (F.col("m") + 1) * 60
    life = Window.partitionBy(*SERIES, F.floor(F.col("m") * 60 / restart)).orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    return per_minute.select(*SERIES, t.cast("long").alias("t"), F.sum("n").over(life).alias("value"))


def counter_increase(samples: DataFrame, seconds: int = 3600) -> DataFrame:
    """(series, window_start, samples, resets, increase, rate) per series and window of ``seconds``.

    A sample at a window's end belongs to it, one at its start to the window before. A
    window with fewer than two samples of a series says nothing about it. The increase
    between the first and the last sample is stretched to the edges, but to no more than
    half the mean distance of samples where the edge is far off, and not beyond the
    point where the counter was 0.
    """
    start = F.floor((F.col("t") - 1) / seconds) * seconds
    rows = samples.withColumn("w", start.cast("long"))
    before = F.lag("value").over(Window.partitionBy(*SERIES, "w").orderBy("t"))
    rows = rows.withColumn("lost", F.when(F.col("value") < before, before))
    g = rows.groupBy(*SERIES, "w").agg(
        F.count(F.lit(1)).alias("samples"), F.count("lost").alias("resets"), F.min("t").alias("t1"), F.max("t").alias("t2"),
        F.min_by("value", "t").alias("v1"), (F.max_by("value", "t") - F.min_by("value", "t") + F.coalesce(F.sum("lost"), F.lit(0))).cast("double").alias("seen"))
    g = g.where("samples > 1").withColumn("span", (F.col("t2") - F.col("t1")).cast("double"))
    mean = F.col("span") / (F.col("samples") - 1)

    def edge(gap: Column) -> Column:
        return F.when(gap >= mean * EDGE, mean / 2).otherwise(gap)

    head, tail = (F.col("t1") - F.col("w")).cast("double"), (F.col("w") + seconds - F.col("t2")).cast("double")
    zero = F.col("span") * (F.col("v1") / F.col("seen"))
    head = F.when(F.col("seen") > 0, F.least(edge(head), zero)).otherwise(edge(head))
    g = g.withColumn("increase", F.col("seen") * ((F.col("span") + head + edge(tail)) / F.col("span")))
    return g.select(*SERIES, F.timestamp_seconds("w").cast("timestamp_ntz").alias("window_start"), "samples", "resets", "increase",
                    (F.col("increase") / seconds).alias("rate"))


def counter_error_ratio(increases: DataFrame) -> DataFrame:
    """(window_start, rps, error_ratio): all series' rates, and the share of status 5xx in them, 9 places."""
    failed = F.coalesce(F.sum(F.when(F.col("status").cast("string").rlike("^5..$"), F.col("rate"))), F.lit(0.0))
    return increases.groupBy("window_start").agg(F.round(F.sum("rate"), 9).alias("rps"), F.round(failed / F.sum("rate"), 9).alias("error_ratio"))


# Mergeable quantiles (OBS-7).

def duration_sketches(log: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(minute, requests, sketch): one KLL sketch of the durations of each minute; no duration, no observation."""
    return (log.where("duration_ms is not null").groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute"))
            .agg(F.count(F.lit(1)).alias("requests"), F.kll_sketch_agg_double("duration_ms", F.lit(k)).alias("sketch")))


def merge_sketches(sketches: DataFrame, size: str, at: str = "minute", k: int = SKETCH_K) -> DataFrame:
    """(window_start, requests, sketch) of windows of ``size`` from finer sketches, whose times are in ``at``."""
    return (sketches.groupBy(F.window(at, size).alias("w"))
            .agg(F.sum("requests").alias("requests"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "requests", "sketch"))


def sketch_quantiles(sketches: DataFrame, qs=QUANTILES) -> DataFrame:
    """``sketches`` with p50, p95, ... in place of ``sketch``."""
    return sketches.select(*[c for c in sketches.columns if c != "sketch"],
                           *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(f"p{round(q * 100)}") for q in qs])


def rank_errors(estimates: DataFrame, log: DataFrame, size: str, qs=QUANTILES) -> DataFrame:
    """(window_start, requests, p50_error, ...): how far each estimate's exact ranks are from its quantile.

    The share of durations below an estimate and the share up to it are counted in the
    log; 0 if the quantile lies between them.
    """
    rows = log.where("duration_ms is not null").select(F.window("ts", size)["start"].cast("timestamp_ntz").alias("w"), "duration_ms")
    names = [f"p{round(q * 100)}" for q in qs]
    met = rows.join(estimates, F.col("w") == F.col("window_start"))
    counts = met.groupBy("window_start").agg(F.count(F.lit(1)).alias("requests"), *[
        c for n in names for c in (F.count_if(F.col("duration_ms") < F.col(n)).alias(f"{n}_below"), F.count_if(F.col("duration_ms") <= F.col(n)).alias(f"{n}_upto"))])
    return counts.select("window_start", "requests", *[
        F.greatest(F.col(f"{n}_below") / F.col("requests") - q, q - F.col(f"{n}_upto") / F.col("requests"), F.lit(0.0)).alias(f"{n}_error") for n, q in zip(names, qs, strict=True)])
