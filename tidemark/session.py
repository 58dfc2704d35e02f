"""Session settings and the shared folder used for staged tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings a running session accepts. Joins are left to Catalyst: it broadcasts a side
# whose measured size is below the threshold and otherwise shuffles, and AQE splits
# shuffle partitions that turn out skewed, also where that costs a later exchange.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings a session takes only when it is built. Recording a call site for every Column call
# doubles the time to build a plan.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(app: str = "tidemark", cores: str = "*", **conf: str) -> SparkSession:
    """Single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RUNTIME_SETTINGS, **STATIC_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def tune(spark: SparkSession) -> None:
    """Applies the runtime settings to a session built elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own; on a cluster a
    missing setting is an error, since a machine-local folder would lose data.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_KEY, own)
    return own


def drop_staged(spark: SparkSession, path: str) -> None:
    """Removes a folder that a run staged for itself."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
