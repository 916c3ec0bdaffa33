"""Session helpers.

Library code never creates or stops the cluster's session; ``local_session``
is for tests, the bench and examples. ``checkpoint_dir`` reads the shared
folder the cluster names in ``spark.checkpoint.dir`` and only falls back to a
scratch folder when the setting is absent (local runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (hundreds of executors, tens of TB): many
# shuffle partitions that AQE coalesces to ~256 MB each, big scan splits, and
# skew splitting for a hot key holding a large share of a table. Applied by
# ``python -m dqspark`` only where the submitter has not set them.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_defaults(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set each key of ``conf`` unless the submitter set it (``--conf`` or
    spark-defaults); SQL settings have built-in defaults, so "set" is read
    from the application's SparkConf, not from ``spark.conf``."""
    submitted = spark.sparkContext.getConf()
    for key, value in conf.items():
        if not submitted.contains(key):
            spark.conf.set(key, value)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dqspark") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster it must be named by the cluster (a shared file system
    folder); a machine-local folder would not survive the loss of the node
    holding it, so none is invented there. Only a local-mode session (tests,
    local runs) without the setting gets a scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master or ""
        if not (master == "local" or master.startswith("local[")):  # local-cluster[..] has executors of its own
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
        current = tempfile.mkdtemp(prefix="dqspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/dqspark-{label}-{uuid.uuid4().hex}"
