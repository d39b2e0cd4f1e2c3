"""Session helpers.

Library code never creates a session of its own: every operator takes
DataFrames and returns DataFrames.  These helpers only serve tests, the
bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the models rely on.  NTZ timestamps make the session zone
# irrelevant for results; UTC is set anyway so that logs read the same
# everywhere.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; Spark's
    # documentation recommends this limit on HotSpot so that a fused stage
    # that would exceed it falls back to per-operator compiled code instead
    # of running an interpreted giant method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Day-grain stages evaluate dozens of exact-decimal measures per row on a
    # few MB of shuffled data: let AQE keep them split across cores instead
    # of coalescing them into one task (default minimum is 1 MB).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "chainstar", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_key(spark: SparkSession) -> tuple:
    """Identity of a session for caching plans built against it."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001  (Spark Connect has no SparkContext)
        app = spark.conf.get("spark.app.id", "")
    return (app, id(spark))


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the
    operator of the cluster.  Only when it is unset (tests, local runs) a
    folder of our own is chosen: ``fallback`` or a fresh temporary folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect)
        pass
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if current:
        return current
    master = sc.master if sc is not None else ""
    if not fallback and (not master.startswith("local") or "cluster" in master):
        # A folder of this machine would not be seen by the executors.
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = fallback or tempfile.mkdtemp(prefix="chainstar-ckpt-")
    os.makedirs(folder, exist_ok=True)
    if sc is not None:
        sc.setCheckpointDir(folder)
    try:
        spark.conf.set("spark.checkpoint.dir", folder)
    except Exception:  # noqa: BLE001  (not settable at run time here)
        pass
    return folder


def scale_conf(input_bytes: int, total_cores: int, split_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run over ``input_bytes`` of compressed Parquet.

    * file splits of ``split_bytes`` (one task per split);
    * an initial shuffle partition count of about one per split (at least
      3 per core): AQE only coalesces downward, so a big
      shuffle must start with enough partitions to fit executor memory;
    * AQE keeps its parallelism-first coalescing (the day-grain measure
      stages are CPU-bound on little data) and splits skewed partitions at
      5x the median.
    """
    parts = max(3 * total_cores, -(-input_bytes // split_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }
