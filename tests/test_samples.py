"""Counter samples with resets and merged duration sketches."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import samples as C

SAMPLES = "endpoint string, status int, t long, value long"


def by_hand(points, w, seconds):
    """increase() over samples (t, value) of one window, point by point."""
    inside = sorted(p for p in points if w < p[0] <= w + seconds)
    if len(inside) < 2:
        return None
    seen, resets = inside[-1][1] - inside[0][1], 0
    for (_, a), (_, b) in zip(inside, inside[1:]):
        if b < a:
            seen, resets = seen + a, resets + 1
    (t1, v1), t2 = inside[0], inside[-1][0]
    span = t2 - t1
    mean = span / (len(inside) - 1)
    head, tail = t1 - w, w + seconds - t2
    head = mean / 2 if head >= 1.1 * mean else head
    tail = mean / 2 if tail >= 1.1 * mean else tail
    if seen > 0:
        head = min(head, span * (v1 / seen))
    return len(inside), resets, seen * (span + head + tail) / span


def test_increase_against_a_walk_over_the_samples(spark):
    rng, rows = random.Random(7), []
    for endpoint in ("/a", "/b", "/c"):
        t, v = 0, 0
        while t < 5000:
            t += rng.choice([15, 15, 15, 30, 200])
            v = 0 if rng.random() < 0.05 else v + rng.randrange(4)
            rows.append((endpoint, 200, t, v))
    got = C.counter_increase(spark.createDataFrame(rows, SAMPLES), 300).collect()
    want = {}
    for endpoint in ("/a", "/b", "/c"):
        points = [(t, v) for e, _, t, v in rows if e == endpoint]
        for w in range(0, 5400, 300):
            if found := by_hand(points, w, 300):
                want[endpoint, w] = found
    assert len(got) == len(want) and sum(r.resets for r in got) > 5
    for r in got:
        n, resets, increase = want[r.endpoint, (r.window_start.hour * 60 + r.window_start.minute) * 60]
        assert (r.samples, r.resets) == (n, resets) and r.increase == pytest.approx(increase) and r.rate == pytest.approx(increase / 300)


def test_edges_resets_and_lone_samples(spark):
    rows = [("/a", 200, 60, 5), ("/a", 200, 120, 9), ("/a", 200, 180, 2),  # a reset: 4 seen, then 2
            ("/a", 200, 300, 2),  # at the window's end: still in it
            ("/a", 200, 301, 3),  # alone in the next
            ("/b", 500, 10, 0), ("/b", 500, 300, 0)]  # nothing happened
    got = {(r.endpoint, r.window_start.minute): r for r in C.counter_increase(spark.createDataFrame(rows, SAMPLES), 300).collect()}
    assert set(got) == {("/a", 0), ("/b", 0)}
    assert got["/a", 0].resets == 1 and got["/a", 0].increase == pytest.approx(6 * (240 + 60) / 240)
    assert got["/b", 0].increase == 0
    ratio = C.counter_error_ratio(C.counter_increase(spark.createDataFrame(rows, SAMPLES), 300)).first()
    assert ratio.error_ratio == 0 and ratio.rps == pytest.approx(7.5 / 300)


def test_samples_begin_at_zero_after_a_restart(spark):
    log = spark.range(200).select((F.lit(0) + F.col("id") * 10).alias("s"), F.lit("/a").alias("endpoint"), F.lit(200).alias("status"))
    log = log.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    got = [(r.t, r.value) for r in C.counter_samples(log, restart=600).orderBy("t").collect()]
    assert got == [((m + 1) * 60, min(6 * (m % 10 + 1), 200 - m // 10 * 60)) for m in range(34)]


def test_merged_sketches_hold_the_bound(spark):
    log = spark.range(60_000).select(F.timestamp_seconds(F.col("id") * 3).cast("timestamp_ntz").alias("ts"),
                                     F.when(F.col("id") % 50 != 0, F.exp(F.randn(3)) * 100).alias("duration_ms"))
    log.cache()
    fine = C.duration_sketches(log)
    hour = C.merge_sketches(fine, "1 hour")
    day = C.merge_sketches(hour, "1 day", "window_start")
    assert hour.count() == 50 and day.count() == 3 and day.agg(F.sum("requests")).first()[0] == 58_800
    for size, sketches in (("1 hour", hour), ("1 day", day)):
        errors = C.rank_errors(C.sketch_quantiles(sketches), log, size).collect()
        assert errors and all(e[f"{p}_error"] <= C.RANK_ERROR for e in errors for p in ("p50", "p95", "p99"))
    few = C.sketch_quantiles(C.duration_sketches(log.where("ts < '1970-01-01 00:01:00'"))).first()
    exact = sorted(r[0] for r in log.where("ts < '1970-01-01 00:01:00' and duration_ms is not null").select("duration_ms").collect())
    assert few.p50 == exact[len(exact) // 2 if len(exact) % 2 else len(exact) // 2 - 1]  # few values: exact
    log.unpersist()


def test_no_requests(spark):
    log = spark.createDataFrame([], "ts timestamp_ntz, endpoint string, status int, duration_ms double")
    assert C.counter_increase(C.counter_samples(log)).count() == 0
    assert C.sketch_quantiles(C.merge_sketches(C.duration_sketches(log), "1 hour")).count() == 0
