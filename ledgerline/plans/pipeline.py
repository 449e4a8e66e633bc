"""End-to-end plans: extracts -> raw -> staging -> marts.

``layers()`` wires the whole chain lazily so Catalyst can prune and push down
across layers (a serving query only computes the columns it needs).
``run_pipeline()`` is the batch job: it lands extracts in the lake, loads raw
parquet tables, evaluates the data tests, and materialises the marts; each
materialisation cuts the lineage for the next stage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.marts import build_marts, write_mart
from ledgerline.operators.raw import load_raw, read_raw, to_raw
from ledgerline.operators.staging import inline_views, register_staging, staging
from ledgerline.plans.lazy import LazyMap
from ledgerline.schemas import SOURCES
from ledgerline.sources.tables import damaged_extracts, extracts

# Fixed evaluation clock used by the registered queries, and the load time of
# each source relative to it (fresh 18 h, warn 30 h, stale 50 h).
AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
LOADED_AT = {
    "calls": AS_OF - dt.timedelta(hours=18),
    "payments": AS_OF - dt.timedelta(hours=30),
    "jobs": AS_OF - dt.timedelta(hours=50),
}
# A clock at which no source is stale yet (calls fresh, the other two warn).
AS_OF_WARN = dt.datetime(2024, 1, 31, 20, 0, 0)


@dataclass
class Layers:
    """Raw, staging and mart tables of one input; mappings whose DataFrames
    are defined on first access (a query only builds what it reads)."""
    raw: Mapping[str, DataFrame]
    staging: Mapping[str, DataFrame]
    marts: Mapping[str, DataFrame] = field(default_factory=dict)


def raw_tables(spark: SparkSession, sf_dir: str, loaded_at: dict | None = None,
               damaged: bool = False):
    """Source name -> raw DataFrame (defined on first access)."""
    loaded_at = loaded_at or LOADED_AT
    ex = damaged_extracts(spark, sf_dir) if damaged else extracts(spark, sf_dir)
    return LazyMap(SOURCES, lambda name: to_raw(ex[name], SOURCES[name], loaded_at[name]))


def materialize(spark: SparkSession, raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write each raw table as parquet under the shared scratch folder and
    read it back: cuts the lineage, so tables read by several jobs are
    computed once (and later reads prune columns)."""
    from ledgerline.session import scratch_path

    base_ = scratch_path(spark, "raw")
    out = {}
    for name, df in raw.items():
        df.write.mode("overwrite").parquet(f"{base_}/{name}")
        out[name] = spark.read.schema(df.schema).parquet(f"{base_}/{name}")
    return out


def layers(spark: SparkSession, sf_dir: str, loaded_at: dict | None = None,
           damaged: bool = False, materialized: bool = False) -> Layers:
    """Raw -> staging -> marts. ``materialized`` stores the raw tables first
    (as the batch pipeline does) instead of deriving every layer lazily."""
    raw = raw_tables(spark, sf_dir, loaded_at, damaged)
    if materialized:
        raw = materialize(spark, raw)
    stg = staging(raw)
    return Layers(raw=raw, staging=stg, marts=build_marts(stg))


def run_pipeline(spark: SparkSession, sf_dir: str, root: str, run_ts: dt.datetime | None = None,
                 database: str = "marts") -> dict:
    """Batch job in build order: lake write -> raw load -> source and staging
    tests -> gate -> marts whose inputs passed (written once) -> mart tests on
    the written tables.

    ``root`` must be a shared folder (object store or distributed FS). Each
    written table cuts the lineage for the next stage, so a lost executor only
    recomputes the current stage. Returns row counts, test results, the
    written marts and the per-model status.
    """
    from ledgerline.operators.quality import DEFAULT_SUITE, gate, layer_tables, run_suite_isolated
    from ledgerline.schemas import extract_schema
    from ledgerline.sources.lake import read_lake, write_lake

    from ledgerline.session import scratch_root

    scratch_root(spark)  # checkpoint folder: the session's, or a new one when unset
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = {}
    raw = {}
    for name, df in extracts(spark, sf_dir).items():
        cols = SOURCES[name]
        write_lake(df, root, name, run_ts)
        landed = read_lake(spark, root, name, extract_schema(cols))
        path = f"{root}/warehouse/raw/{name}"
        rows[name] = load_raw(landed, cols, run_ts, path)
        raw[name] = read_raw(spark, cols, path)
    stg = register_staging(spark, raw)
    upstream_tests = [t for t in DEFAULT_SUITE if t.layer != "marts"]
    mart_tests = [t for t in DEFAULT_SUITE if t.layer == "marts"]
    # one row per declared test: evaluated once, reused by the gate and the caller
    upstream = run_suite_isolated(layer_tables(raw, stg, {}), upstream_tests, views=inline_views())
    before = {r["model"]: r["status"] for r in gate(upstream).collect()}
    written = {}
    marts = build_marts(stg)
    for name in marts:
        if before.get(name, "pass") != "skip":
            written[name] = write_mart(spark, marts[name], name, database)
    results = upstream
    tested = [t for t in mart_tests if t.model in written]
    if tested:
        results = upstream.unionByName(run_suite_isolated(written, tested))
    status = {r["model"]: r["status"] for r in gate(results).collect()}
    return {"rows": rows, "results": results, "marts": written, "status": status}


def published_marts(spark: SparkSession, database: str = "marts") -> dict[str, DataFrame]:
    """Read path: the marts written by ``run_pipeline`` as catalog tables.

    Serving functions take mart DataFrames, so they run unchanged on these
    (each mart is built once per run and read by every serving query). A mart
    the gate skipped in the first run is absent.
    """
    names = ("mart_call_funnel", "mart_revenue", "mart_jobs")
    return {n: spark.table(f"{database}.{n}") for n in names
            if spark.catalog.tableExists(f"{database}.{n}")}
