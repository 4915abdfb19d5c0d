"""Session settings the plans rely on, and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings. No broadcast threshold is raised: a side is broadcast
# only where Spark's own size estimate (or AQE's measured size) allows it.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even if that costs the next operator a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}
# The retail plans: rows that lie by order meet others on (order, product) where they lie.
RETAIL_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def tune(spark: SparkSession, more: dict[str, str] | None = None) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in (RUNTIME_CONF | (more or {})).items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: str | int = "*",
    app: str = "basketry",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder: the one the cluster names, or a scratch one in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="basketry-checkpoint-")
    sc.setCheckpointDir(named)
    return named
