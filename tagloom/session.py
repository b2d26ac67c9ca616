"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library's plans assume. AQE re-plans joins at runtime (it
# demotes a side to broadcast only when its measured size is under
# spark.sql.adaptive.autoBroadcastJoinThreshold, and splits skewed
# partitions of a sort-merge join), and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a partition is skewed past 5x the median and 256 MB: it is split and
    # the matching side replicated (a hot tag or term cannot stall one task)
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    # rebalance hints (month layout before writes) also split hot keys
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tagloom", extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. A folder of this machine
    is made only for a local master, where it is shared by all threads;
    without a configured folder any other master is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"master {master!r} needs a shared folder in spark.checkpoint.dir")
        configured = tempfile.mkdtemp(prefix="tagloom-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder.

    Used for intermediate tables that must survive executor loss (written
    tables instead of in-memory lineage) and for round-trip outputs.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tagloom-scratch/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared scratch folder and read it
    back: it survives lost executors, and joins of it get plain exchanges,
    whose large partitions adaptive execution can split."""
    return df.sparkSession.read.schema(df.schema).parquet(written_path(df, name))


def side_session(spark: SparkSession) -> SparkSession:
    """Another session of the application with the same SQL settings, also
    those that were set while running."""
    side = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            side.conf.set(key, value)
    return side


def written_path(df: DataFrame, name: str) -> str:
    """Where a frame has been written, for reading it in another session."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def spread_thin_input(df, *keys: str):
    """Hash-redistribute a DataFrame that arrives in fewer partitions than the
    cluster has cores (e.g. one large unsplittable file), so that the
    CPU-heavy text work after it runs in parallel. Inputs that are already
    split at least that finely (any large table) are returned unchanged, so
    this adds no shuffle at scale."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)
