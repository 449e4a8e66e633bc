"""Raw load (SNK-3): fixed text columns plus the load timestamp."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.timeutil import ntz_lit
from ledgerline.operators.marts import VERSION_PREFIX, mart_versions, remove_old_versions
from ledgerline.schemas import LOADED_AT, raw_schema


def _loaded_at_col(loaded_at) -> Column:
    if isinstance(loaded_at, Column):
        return loaded_at.cast("timestamp_ntz")
    return ntz_lit(loaded_at)


def to_raw(df: DataFrame, columns: list[str], loaded_at) -> DataFrame:
    """Project onto the raw layout: every listed column as text, absent or
    NULL values as ``''`` (raw text is never NULL), plus ``_loaded_at``."""
    present = set(df.columns)
    cols = [
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in present
        else F.lit("").alias(c)
        for c in columns
    ]
    return df.select(*cols, _loaded_at_col(loaded_at).alias(LOADED_AT))


def load_raw(df: DataFrame, columns: list[str], loaded_at, path: str, skip_empty: bool = True) -> int:
    """Full replace of a raw table stored as parquet below ``path``; returns the
    number of rows loaded (read back from the written table). Each load writes a
    version folder of its own; readers take the newest committed one, so a failed
    load leaves the previous table in place.

    An empty extract loads nothing and leaves the previous raw table as is
    (``isEmpty`` stops at the first row).
    """
    if skip_empty and df.isEmpty():
        return 0
    out = to_raw(df, columns, loaded_at)
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    version = f"{path}/{VERSION_PREFIX}{stamp}-{uuid.uuid4().hex[:8]}"
    out.write.mode("errorifexists").parquet(version)
    remove_old_versions(out.sparkSession, path, current=version)
    return out.sparkSession.read.schema(raw_schema(columns)).parquet(version).count()


def read_raw(spark, columns: list[str], path: str) -> DataFrame:
    """The raw table at ``path``; zero rows (typed) if it was never loaded."""
    from ledgerline.sources.lake import path_exists

    done = [v for v in mart_versions(spark, path) if path_exists(spark, f"{v}/_SUCCESS")]
    if not done:
        return spark.createDataFrame([], raw_schema(columns))
    return spark.read.schema(raw_schema(columns)).parquet(done[-1])
