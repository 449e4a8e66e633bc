"""STR-2: new lake extracts appended to a raw table exactly once.

The file stream source remembers processed files in the checkpoint, so each
run picks up only extracts landed since the previous one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.raw import to_raw
from ledgerline.schemas import extract_schema
from ledgerline.sources.lake import source_root


def ingest_stream(spark: SparkSession, root: str, source: str, columns: list[str], out: str,
                  checkpoint: str, loaded_at=None) -> StreamingQuery:
    """Process all extracts available now into the raw parquet table ``out``.

    ``loaded_at``: load timestamp for the rows (defaults to processing time).
    """
    from pyspark.sql import functions as F

    stream = (spark.readStream.schema(extract_schema(columns))
              .json(source_root(root, source) + "/*/*/*/*"))
    raw = to_raw(stream, columns, loaded_at if loaded_at is not None else F.current_timestamp())
    q = (raw.writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
    q.awaitTermination()
    return q


CORRUPT = "_corrupt_record"


def ingest_stream_checked(spark: SparkSession, root: str, source: str, columns: list[str], out: str, quarantine: str,
                          checkpoint: str, loaded_at=None) -> None:
    """As ``ingest_stream``, with the records that are no JSON kept apart instead of loaded as blank rows.

    Two streams read the extracts, each with a checkpoint of its own: good records go to
    ``out`` as raw rows, the others to ``quarantine`` as (record, file, _loaded_at). Each
    record ends up in exactly one of the two, once.
    """
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    schema = T.StructType([*extract_schema(columns), T.StructField(CORRUPT, T.StringType())])
    when = loaded_at if loaded_at is not None else F.current_timestamp()

    def records():
        lines = spark.readStream.text(source_root(root, source) + "/*/*/*/*").select("value", F.col("_metadata.file_name").alias("file"))
        read = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        return lines.where(F.trim("value") != "").withColumn("read", read)

    broken = F.col("read").isNull() | F.col(f"read.{CORRUPT}").isNotNull()
    good = to_raw(records().where(~broken).select("read.*"), columns, when)
    bad = to_raw(records().where(broken).select(F.col("value").alias("record"), "file"), ["record", "file"], when)
    queries = [df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start(path)
               for df, name, path in ((good, "good", out), (bad, "bad", quarantine))]
    for q in queries:
        q.awaitTermination()
