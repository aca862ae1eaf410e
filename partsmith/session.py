"""Session helpers: building a session for tests/bench and resolving the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every partsmith job relies on.  AQE re-plans joins at runtime: a join
# side whose *measured* shuffle output is below the adaptive broadcast threshold
# is turned into a broadcast hash join, everything else stays sort-merge.  This
# is the size check behind every dimension join that does not carry an explicit
# broadcast hint (explicit hints are only used for inputs with a proven bound).
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.parquet.filterPushdown": "true",
    # wide rows (a parsed product document has ~100 fields) still get
    # whole-stage code generation
    "spark.sql.codegen.maxFields": "1000",
    # Partition sizing: scan splits and post-shuffle partitions of ~128 MB keep
    # every task's working set far below executor memory; AQE coalesces small
    # shuffle partitions up to this size and splits skewed ones.  On a cluster,
    # set spark.sql.shuffle.partitions to about (largest shuffle bytes / 128 MB)
    # and let AQE shrink it.
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "partsmith") -> SparkSession:
    """Create (or reuse) a session with the engine settings applied."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name).master(master or f"local[{cpus}]")
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    parts = shuffle_partitions or int(cpus) * 2
    builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    # remove reliable-checkpoint files once the checkpointed data is unreachable
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable engine settings to an existing session."""
    for key, value in ENGINE_CONF.items():
        # a static setting of a running session stays as configured
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def run_marker(spark: SparkSession) -> str:
    """The current UTC time in whole seconds, as text.  Taken once before a run and passed on
    as its timestamp, so that no row or micro-batch reads the clock again."""
    return spark.sql("SELECT date_format(to_utc_timestamp(now(), current_timezone()),"
                     " 'yyyy-MM-dd HH:mm:ss')").first()[0]


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder and is
    used as is.  Only in local mode (a unit test on a laptop) does an unset folder fall
    back to a fresh local one; on a cluster it is an error, as executors would not share
    it.
    """
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001 - Spark Connect: the server's setting applies
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from e
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="partsmith-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/partsmith-{name}-{uuid.uuid4().hex[:12]}"
