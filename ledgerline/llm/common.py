"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: White space between words: U+0020 and U+0009 to U+000D, nothing else.
SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array (null or blank text: empty array)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to a new folder below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table every executor can read, and lets expensive
    work that two branches need run once.
    """
    path = scratch_path(df.sparkSession, "llm", tag)
    df.write.option("compression", "zstd").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.written_at = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete tables of ``materialise`` that no later step reads: all that used them is written itself.

    The driver's collector runs too, because Spark removes the shuffle files of finished
    steps only once their plans are collected.
    """
    import gc

    for df in written:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    written[0].sparkSession.sparkContext._jvm.System.gc()


def rows_at_most(df: DataFrame, n: int) -> bool:
    """Whether a written table has at most ``n`` rows (counts n + 1 rows at most)."""
    return df.limit(n + 1).count() <= n


def with_broadcast_if(df: DataFrame, n: int) -> DataFrame:
    """``df`` marked for broadcast when its row count is checked to be at most ``n``."""
    return F.broadcast(df) if rows_at_most(df, n) else df


def shipped(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """``value`` (of bounded size) broadcast with its classes; the result gives it back inside a task."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)
