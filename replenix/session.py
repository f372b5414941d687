"""Session construction and shared scratch locations.

Cluster sessions come configured; ``build_session`` is for tests, the bench
and local runs.  Scratch data (intermediate tables, round-trip checks) always
lives below ``spark.checkpoint.dir`` — the shared folder the cluster names —
and a local one is created only when the session has none (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on for correct results, applied to any session.
CORRECTNESS_CONF = {
    # re-runs replace only the partitions they write (never the whole table)
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # exec_date folders stay strings, as declared
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # time-zone-less Parquet timestamps stay zone-less (year/day never shift with the session zone)
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}

# Execution settings for local runs; a cluster sets its own sizes.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    # reliable checkpoints are serialized rows; compress them (a cluster sets this too)
    "spark.checkpoint.compress": "true",
}


def build_session(master: str | None = None, app: str = "replenix",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf.update(CORRECTNESS_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_correctness_conf(spark)
    checkpoint_root(spark)
    return spark


def production_session(app: str = "replenix", master: str | None = None) -> SparkSession:
    """The session of a submitted job: master, memory and sizes are the submitter's.

    Only settings that results depend on are added; ``LOCAL_CONF`` is for tests and the bench.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    apply_correctness_conf(spark)
    return spark


def apply_correctness_conf(spark: SparkSession) -> None:
    for k, v in CORRECTNESS_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from the session; only when it is unset on a local-mode session (tests,
    local runs) a fresh folder is created and registered.  A cluster session
    without one is an error: a machine-local folder is not visible to the other
    executors and does not survive losing this one.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if cur:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(cur)
        return sc.getCheckpointDir() or cur
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (e.g. on HDFS or an "
                           "object store) for checkpoints and intermediate tables")
    path = tempfile.mkdtemp(prefix="replenix-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/replenix-scratch/{name}-{uuid.uuid4().hex[:12]}"
