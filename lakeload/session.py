"""Session helpers: building a session for tests and benches, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "lakeload",
                  shuffle_partitions: int | None = None, driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    """A session with AQE on and the UI off; for tests, benches and scripts (clusters bring their own)."""
    master = master or os.environ.get("LAKELOAD_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        # PySpark records the Python call site of every Column call for error messages; building
        # wide projections then costs milliseconds per call on the driver.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is only read here.  When it is
    unset (local tests) a fresh scratch folder is created once and registered, never reused across runs.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        current = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not current:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            current = jdir.get()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="lakeload-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(current)
    return current


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder (for query-owned tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lakeload/{name}-{uuid.uuid4().hex[:12]}"
