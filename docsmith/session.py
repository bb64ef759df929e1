"""Spark session settings for the document builder.

The plan is a set of per-relation aggregations joined on the item key, so
the settings that matter are the adaptive ones: AQE coalesces and splits
shuffle partitions at run time, turns a sort-merge join into a broadcast
join only when the measured side is under the threshold, and splits skewed
join partitions.  No setting here depends on the data size.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Broadcast only below this size; larger sides fall back to sort-merge joins.
BROADCAST_THRESHOLD = str(64 * 1024 * 1024)

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot join key is split even where that costs another exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # small shuffles are not squeezed into one or two tasks; large ones are
    # still cut at the advisory size
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": BROADCAST_THRESHOLD,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": BROADCAST_THRESHOLD,
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "docsmith", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_scale_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_scale_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (e.g. the driver's);
    what its owner has set stays."""
    given = spark.conf.getAll
    for k, v in SCALE_CONF.items():
        if k not in given and spark.conf.isModifiable(k):
            spark.conf.set(k, v)


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Actions inside remove their shuffle files when they end, rather than when the driver
    next collects its garbage: of several writes only one has its shuffles on disk.  What
    the session's owner has set stays."""
    given = RELEASE in spark.conf.getAll
    if not given:
        spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if not given:
            spark.conf.unset(RELEASE)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables: ``spark.checkpoint.dir`` as the
    cluster names it.  Only a local-mode session without one gets a scratch
    folder; on a cluster its absence is an error."""
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is invisible to the other executors
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="docsmith-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
