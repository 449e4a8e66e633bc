"""Alert islands, freshness breaches against a brute-force evaluation grid,
interpolated quantiles against exact ones, banding."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import metrics as M

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def test_alert_islands_fire_only_after_for(spark):
    rows = []
    for i in range(40):  # every 60 s
        t = T0 + dt.timedelta(seconds=60 * i)
        cond = (5 <= i <= 7) or (15 <= i <= 25)  # 2 min island, 10 min island
        rows.append(("p", t, cond))
    ev = spark.createDataFrame(rows, "pipeline string, eval_ts timestamp_ntz, breach boolean")
    out = sorted(M.alert_islands(ev, "pipeline", "eval_ts", "breach").collect(), key=lambda r: r.start)
    assert [(r.held_seconds, r.fired) for r in out] == [(120, False), (600, True)]
    assert out[1].fired_at == T0 + dt.timedelta(seconds=15 * 60 + 300)


def _brute(arrivals, as_of, thr=172800, g=60, fs=300):
    """Evaluate every grid point from first arrival to as_of."""
    arrivals = sorted(arrivals)
    start = int(arrivals[0].replace(tzinfo=dt.timezone.utc).timestamp()) // g * g
    end = int(as_of.replace(tzinfo=dt.timezone.utc).timestamp())
    epoch = [a.replace(tzinfo=dt.timezone.utc).timestamp() for a in arrivals]
    islands, cur, j = [], None, 0
    for t in range(start, end + 1, g):
        while j < len(epoch) and epoch[j] <= t:
            j += 1
        cond = j > 0 and t - epoch[j - 1] > thr
        if cond and cur is None:
            cur = [t, t]
        elif cond:
            cur[1] = t
        elif cur is not None:
            islands.append(tuple(cur))
            cur = None
    if cur is not None:
        islands.append(tuple(cur))
    return [(a, b, b - a, b - a >= fs) for a, b in islands]


def test_freshness_breaches_match_brute_force(spark):
    arr = [T0, T0 + dt.timedelta(hours=5), T0 + dt.timedelta(hours=53, seconds=30),
           T0 + dt.timedelta(hours=101, minutes=2), T0 + dt.timedelta(hours=149, minutes=4, seconds=59),
           T0 + dt.timedelta(days=9)]
    as_of = T0 + dt.timedelta(days=12)
    df = spark.createDataFrame([("x", a) for a in arr], "pipeline string, t timestamp_ntz")
    got = sorted((int(r.start.replace(tzinfo=dt.timezone.utc).timestamp()),
                  int(r.end.replace(tzinfo=dt.timezone.utc).timestamp()), r.held_seconds, r.fired)
                 for r in M.freshness_breaches(df, "pipeline", "t", as_of).collect())
    assert got == _brute(arr, as_of)
    assert any(not f for *_, f in got) and any(f for *_, f in got)


def test_latency_quantiles_within_bucket_of_exact(spark):
    from tests.conftest import SF_SMALL

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    log = M.request_log(ev)
    est = M.latency_quantiles(log, size="1 day")
    exact = log.groupBy(F.window("ts", "1 day").alias("w")).agg(
        F.percentile("duration_ms", 0.5).alias("e50"), F.percentile("duration_ms", 0.95).alias("e95"))
    j = est.join(exact.select(F.col("w.start").alias("window_start"), "e50", "e95"), "window_start").collect()
    assert j
    bounds = [0.0] + [float(b) for b in M.LATENCY_BOUNDS_MS]

    def bucket(v):
        for lo, hi in zip(bounds, bounds[1:]):
            if lo <= v <= hi:
                return lo, hi
        return bounds[-1], float("inf")

    for r in j:
        for est_v, ex in ((r.p50, r.e50), (r.p95, r.e95)):
            lo, hi = bucket(ex)
            width = hi - lo
            assert abs(est_v - ex) <= width + 1e-9


def test_band_steps(spark):
    df = spark.createDataFrame([(0.0,), (199.9,), (200.0,), (999.0,), (1000.0,), (None,)], "v double")
    got = [r.band for r in M.band(df, "v", M.BANDS["latency_ms"]).collect()]
    assert got == ["green", "green", "yellow", "yellow", "red", None]


def test_breaches_with_a_threshold_below_a_day_and_late_arrivals(spark):
    import random

    rng = random.Random(2)
    arrivals = sorted(T0 + dt.timedelta(minutes=rng.randrange(6000)) for _ in range(60))
    as_of = T0 + dt.timedelta(minutes=6200)
    late = [as_of + dt.timedelta(hours=1)]
    df = spark.createDataFrame([("p", t) for t in arrivals + late], "pipeline string, t timestamp_ntz")
    epoch = lambda t: int(t.replace(tzinfo=dt.timezone.utc).timestamp())
    got = sorted((epoch(r.start), epoch(r.end), r.held_seconds, r.fired)
                 for r in M.freshness_breaches(df, "pipeline", "t", as_of, threshold_seconds=7200).collect())
    assert got == _brute(arrivals, as_of, thr=7200) and got


def test_requests_without_duration_are_no_observations(spark):
    log = spark.createDataFrame([(T0, None), (T0, 3.0)], "ts timestamp_ntz, duration_ms double")
    row = M.latency_quantiles(log).first()
    assert row.total == 1 and row.p95 <= 5


def test_every_metric_has_its_own_bands(spark):
    from ledgerline.operators import metrics as M

    cases = [("run_seconds", 29.9, "green"), ("run_seconds", 30.0, "yellow"), ("run_seconds", 120.0, "red"), ("age_seconds", 86399.0, "green"), ("age_seconds", 172800.0, "red"),
             ("latency_ms", 200.0, "yellow"), ("latency_ms", 1000.0, "red"), ("error_ratio", 0.049, "green"), ("error_ratio", 0.05, "red"), ("failed_tests", 0.0, "green"),
             ("failed_tests", 1.0, "red"), ("failed_tests", None, None), ("unknown", 5.0, None)]
    df = spark.createDataFrame([(m, str(i), v) for i, (m, v, _) in enumerate(cases)], "metric string, label string, value double")
    assert {r.label: r.band for r in M.band_all(df).collect()} == {str(i): b for i, (*_, b) in enumerate(cases)}
