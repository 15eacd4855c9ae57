"""Spark session settings for the package.

On a cluster the session comes from ``spark-submit``; these helpers only
fill in what is unset (local runs and tests).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Fixed when the session starts: no web UI server, no console progress bar.
STARTUP = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; past
    # that size a fused stage is better split (Spark docs recommend 8000).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tripflow", extra: dict | None = None) -> SparkSession:
    """The session with the package defaults filled in.

    A setting the cluster launched with (``spark-defaults.conf``,
    ``--conf``) wins over ``DEFAULTS``; ``shuffle_partitions`` and ``extra``
    are explicit choices of the caller and always apply.
    """
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**STARTUP, **explicit}.items():
        builder = builder.config(k, v)
    launched = builder.getOrCreate().sparkContext.getConf()
    for k, v in DEFAULTS.items():
        if k not in explicit and not launched.contains(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    return spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint dir; set a local one only when unset and
    the master is local (tests): on a cluster it would be a folder of each
    machine."""
    root = checkpoint_root(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tripflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root
