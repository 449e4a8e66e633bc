"""SparkSession construction and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: exact ANSI casts, UTC wall clock, AQE for
# join strategy / skew splitting / partition coalescing at runtime.
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Settings meant for a large cluster reading ~100 TB: start wide and let AQE
# coalesce shuffle partitions to ~256 MB, split files at 256 MB, split skewed
# join partitions, keep broadcasts under a measured size.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "ledgerline", extra: dict | None = None,
                cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    ``master`` is only set for local runs; on a cluster the launcher decides
    and ``cluster=True`` adds ``CLUSTER_CONF``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, lake round trips and stream state.

    Taken from ``spark.checkpoint.dir`` (the cluster's shared folder). Only when
    a session with a local master has none (tests) a fresh temporary folder is
    created and registered as the checkpoint dir; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder they share with the driver")
        current = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        sc.setCheckpointDir(current)
        spark.conf.set("spark.checkpoint.dir", current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A unique sub-path of the scratch root (new for every call)."""
    import uuid

    return "/".join([scratch_root(spark), *parts, uuid.uuid4().hex])


def shared_warehouse(spark: SparkSession) -> str:
    """The warehouse folder of the session, which all executors must reach: on a cluster a folder of the
    driver's machine (the default) is an error."""
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = root.startswith("file:") or "://" not in root and root.startswith("/")
    if local and spark.sparkContext.master.split("[")[0] not in ("local", "local-cluster") and not spark.conf.get("spark.checkpoint.dir", "").startswith(("file:", "/")):
        raise RuntimeError("spark.sql.warehouse.dir is a local folder: executors need one they share with the driver")
    return root
