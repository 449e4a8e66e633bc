"""JSON lake of source extracts (SRC-1/2/4, SNK-1/2).

Layout: ``{root}/raw/{source}/YYYY/MM/DD/{HHMMSS}[-full-{stamp}]/part-*.json``: one
directory per run (Spark writes a set of part files per run instead of one
file). Run directories sort chronologically. Readers use committed runs only
(``_SUCCESS``); a ``-full`` run replaces all runs before it from the moment it
commits, so a run that fails leaves the extracts before it in place.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def source_root(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/raw/{source}"


def run_dir(root: str, source: str, run_ts: dt.datetime) -> str:
    return f"{source_root(root, source)}/{run_ts:%Y/%m/%d}/{run_ts:%H%M%S}"


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def write_lake(df: DataFrame, root: str, source: str, run_ts: dt.datetime,
               append: bool = False) -> str:
    """SNK-1 (default): replace every earlier extract of the source, so a
    re-run is idempotent. SNK-2 (``append=True``): keep history and add a new
    run-stamped directory. Returns the run directory."""
    spark = df.sparkSession
    out = run_dir(root, source, run_ts)
    if append:
        df.write.mode("errorifexists").json(out)
        return out
    before = run_dirs(spark, root, source)
    out += f"{FULL}{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}"
    df.write.mode("errorifexists").json(out)
    remove_replaced(spark, before)
    return out


#: Mark in the name of a run that replaces all earlier ones.
FULL = "-full-"
#: Age of its commit from which a replaced run is removed; longer than any read or run, as for marts.
RETENTION = dt.timedelta(hours=24)


def remove_replaced(spark: SparkSession, runs: list[str], now: dt.datetime | None = None) -> list[str]:
    """Free the space of replaced runs that were committed more than ``RETENTION`` ago; readers in flight keep theirs."""
    limit = ((now or dt.datetime.now(dt.timezone.utc)) - RETENTION).timestamp() * 1000
    removed = []
    for run in runs:
        fs, done = _fs(spark, f"{run}/_SUCCESS")
        if fs.exists(done) and fs.getFileStatus(done).getModificationTime() < limit:
            fs.delete(_fs(spark, run)[1], True)
            removed.append(run)
    return removed


def run_dirs(spark: SparkSession, root: str, source: str) -> list[str]:
    """Run directories of a source, oldest first (listing metadata only, one per run)."""
    fs, p = _fs(spark, source_root(root, source) + "/*/*/*/*")
    statuses = fs.globStatus(p)
    if statuses is None:
        return []
    return sorted(str(s.getPath()) for s in statuses if s.isDirectory())


def committed_runs(spark: SparkSession, root: str, source: str) -> list[str]:
    """The runs a reader sees, oldest first: committed ones from the last one that replaced the others on."""
    runs = [d for d in run_dirs(spark, root, source) if path_exists(spark, f"{d}/_SUCCESS")]
    full = max((d for d in runs if FULL in d), key=lambda d: d.rsplit(FULL, 1)[-1], default=None)
    if full is None:
        return runs
    return [full] + [d for d in runs if FULL not in d and d > full]


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """SRC-4: zero rows with the typed schema."""
    return spark.createDataFrame([], schema)


def read_lake(spark: SparkSession, root: str, source: str, schema: T.StructType,
              latest: bool = False, multiline: bool = False) -> DataFrame:
    """SRC-1: every extract of the source; SRC-2 (``latest=True``): only the
    newest committed run. Missing or empty source -> zero rows (SRC-4).

    The schema is always given (no inference pass). ``multiline`` reads
    files that hold one JSON array each instead of JSON lines.
    """
    runs = committed_runs(spark, root, source)
    if not runs:
        return empty_frame(spark, schema)
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    if multiline:
        reader = reader.option("multiLine", True)
    return reader.json(runs[-1:] if latest else runs)
