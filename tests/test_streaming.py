"""STR-1 lateness across micro-batches and STR-2 exactly-once ingestion."""

import datetime as dt

from ledgerline.session import scratch_path
from ledgerline.streaming.requests import run_request_rate


def test_late_rows_past_watermark_are_dropped(spark):
    base = scratch_path(spark, "stream-test")
    src, out, ck = base + "/events", base + "/out", base + "/ck"
    t = dt.datetime(2024, 1, 1, 10, 0, 0)

    def write(rows, name):
        spark.createDataFrame(
            [(i, ts, 1, et, 1.0, '{"k": 1}') for i, (ts, et) in enumerate(rows)],
            "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
        ).coalesce(1).write.mode("overwrite").parquet(f"{src}/{name}")

    write([(t + dt.timedelta(minutes=m), "view") for m in range(0, 21)], "f1")
    run_request_rate(spark, src + "/*", out, ck)
    # watermark is now 10:15: a row at 10:01 is late, rows at 10:30 and 10:40 are not
    write([(t + dt.timedelta(minutes=1, seconds=5), "error"), (t + dt.timedelta(minutes=30), "error"),
           (t + dt.timedelta(minutes=40), "view")], "f2")
    run_request_rate(spark, src + "/*", out, ck)
    got = {r.window_start: (r.requests, r.errors) for r in spark.read.parquet(out).collect()}
    assert got[dt.datetime(2024, 1, 1, 10, 1)] == (1, 0)   # late error row dropped
    assert got[dt.datetime(2024, 1, 1, 10, 30)] == (1, 1)  # closed by the 10:40 row's watermark
    assert dt.datetime(2024, 1, 1, 10, 40) not in got     # still open


def test_ingest_stream_is_exactly_once(spark):
    from pyspark.sql import functions as F

    from ledgerline.sources import lake as L
    from ledgerline.streaming.ingest import ingest_stream

    root = scratch_path(spark, "ingest-test")
    cols = ["id", "amount"]
    df = spark.createDataFrame([("1", "10"), ("2", "20")], "id string, amount string")
    L.write_lake(df, root, "w", dt.datetime(2024, 1, 1, 1), append=True)
    ingest_stream(spark, root, "w", cols, root + "/out", root + "/ck", dt.datetime(2024, 1, 2))
    ingest_stream(spark, root, "w", cols, root + "/out", root + "/ck", dt.datetime(2024, 1, 2))  # no new files
    L.write_lake(df.withColumn("id", F.lit("3")), root, "w", dt.datetime(2024, 1, 1, 2), append=True)
    ingest_stream(spark, root, "w", cols, root + "/out", root + "/ck", dt.datetime(2024, 1, 2))
    assert sorted(r.id for r in spark.read.parquet(root + "/out").collect()) == ["1", "2", "3", "3"]


def test_records_that_are_no_json_are_kept_apart(spark):
    import datetime as dt

    from ledgerline.session import scratch_path
    from ledgerline.sources import lake as L
    from ledgerline.streaming.ingest import ingest_stream_checked

    root = scratch_path(spark, "lake")
    out, bad, ck = root + "/out", root + "/bad", root + "/ck"
    runs = [['{"id":"1","note":"a"}', '{"id":"2","no', "no json", '{"id":"3"}'], ['{"id":"4","note":null}', "[1", "", '{"id":5,"other":1}']]
    for day, lines in enumerate(runs, 1):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(L.run_dir(root, "w", dt.datetime(2024, 1, day)))
        ingest_stream_checked(spark, root, "w", ["id", "note"], out, bad, ck, dt.datetime(2024, 1, 9))
    assert sorted((r.id, r.note) for r in spark.read.parquet(out).collect()) == [("1", "a"), ("3", ""), ("4", ""), ("5", "")]
    kept = spark.read.parquet(bad).collect()
    assert sorted(r.record for r in kept) == ["[1", "no json", '{"id":"2","no'] and all(r.file.startswith("part-") for r in kept)
