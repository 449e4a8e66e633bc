"""STR-1: request rate and error ratio as a running query.

Tumbling 1-minute windows with a 5-minute watermark, append mode: a window is
emitted once the watermark passes its end, rows later than the watermark are
dropped. State is bounded by the watermark (windows older than it are evicted).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.metrics import request_log

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def request_rate_stream(log_stream: DataFrame, watermark: str = "5 minutes",
                        size: str = "1 minute", seconds: int = 60) -> DataFrame:
    """Windowed requests/s and 5xx ratio over a streaming request log."""
    # a watermark needs TIMESTAMP (not TIMESTAMP_NTZ); the session zone is UTC
    s = log_stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    is5xx = F.col("status").cast("string").rlike("^5..$")
    g = s.groupBy(F.window("ts", size).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(is5xx).alias("errors"))
    return g.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests",
        (F.col("requests") / F.lit(seconds)).alias("rps"), "errors",
        (F.col("errors") / F.col("requests")).alias("error_ratio"))


def parquet_stream(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """Stream a parquet table given as a directory or as a single file.

    A file stream source lists a directory; a single file is addressed with a
    one-file glob and its folder as the base path.
    """
    if path.rstrip("/").endswith(".parquet") and "*" not in path:
        p = path.rstrip("/")
        folder = p.rsplit("/", 1)[0]
        return (spark.readStream.schema(schema).option("basePath", folder)
                .parquet(p[:-1] + "[" + p[-1] + "]"))
    return spark.readStream.schema(schema).parquet(path)


def run_request_rate(spark: SparkSession, events_path: str, out: str, checkpoint: str,
                     watermark: str = "5 minutes") -> StreamingQuery:
    """Read the events table as a stream, append closed windows to ``out``
    (parquet), process everything available, then stop."""
    events = parquet_stream(spark, EVENTS_SCHEMA, events_path)
    agg = request_rate_stream(request_log(events), watermark)
    q = (agg.writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
    q.awaitTermination()
    return q
