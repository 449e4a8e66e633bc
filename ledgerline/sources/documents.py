"""Document-collection export reader (SRC-3) and writer for round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Typed job document: numeric value, nullable completion time.
JOB_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("job_id", T.StringType()),
    T.StructField("related_call_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("service_category", T.StringType()),
    T.StructField("value", T.DecimalType(10, 2)),
    T.StructField("technician", T.StringType()),
    T.StructField("scheduled_at", T.StringType()),
    T.StructField("completed_at", T.StringType()),
])


def read_documents(spark: SparkSession, path: str, schema: T.StructType = JOB_DOCUMENT_SCHEMA,
                   multiline: bool = False) -> DataFrame:
    """Read an export (JSON lines, or JSON arrays with ``multiline``), drop
    the internal ``_id``; no filter."""
    reader = spark.read.schema(schema)
    if multiline:
        reader = reader.option("multiLine", True)
    df = reader.json(path)
    return df.drop("_id") if "_id" in df.columns else df


def export_documents(jobs_extract: DataFrame, path: str) -> None:
    """Write jobs as documents: typed value, NULL completion when blank,
    a synthetic ``_id``."""
    docs = jobs_extract.select(
        F.sha1(F.col("job_id")).alias("_id"), "job_id", "related_call_id", "status", "service_category",
        F.col("value").cast("decimal(10,2)").alias("value"), "technician", "scheduled_at",
        F.nullif(F.col("completed_at"), F.lit("")).alias("completed_at"))
    docs.write.mode("overwrite").json(path)
