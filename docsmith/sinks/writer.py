"""Document sinks.

A rebuild never deletes the live target first.  Each run writes a new
version folder per document type; only when all types are written and checked does
one manifest publish them (``manifest.py``).  A failed run leaves the previous
versions live, and a retried task overwrites only its own files.  Old versions go
only when a number to retain is asked for.
"""

from __future__ import annotations

import os
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffles_released
from .manifest import history, ledger_path, newest


CODEC = "spark.sql.parquet.compression.codec"


def new_version() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def version_path(target: str, version: str) -> str:
    return os.path.join(target, f"v={version}")


def write_documents(df: DataFrame, path: str, fmt: str = "parquet", batch_size: int | None = None,
                    mode: str = "errorifexists", options: dict | None = None,
                    writers: int | None = None, partition_by: tuple = ()) -> None:
    """Write one document set to files.  ``batch_size`` bounds records per output
    file (the original's bulk size), ``writers`` the number of write tasks (its
    concurrent requests).  Parquet is written with zstd, unless the options or the session
    name a codec: lists that many documents have in common are small then, however long."""
    given = {k.lower() for k in (options or {})} | set(df.sparkSession.conf.getAll)
    if fmt == "parquet" and given.isdisjoint({"compression", "parquet.compression", CODEC}):
        options = {**(options or {}), "compression": "zstd"}
    w = _writer(df, fmt, mode, options, writers)
    if batch_size:
        w = w.option("maxRecordsPerFile", int(batch_size))
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_released(df.sparkSession):
        w.save(path)


def write_to_connector(df: DataFrame, fmt: str, options: dict, mode: str = "append",
                       writers: int | None = None) -> None:
    """Write one document set through a data source that names its target in its
    options (an index, a topic) instead of a path."""
    _writer(df, fmt, mode, options, writers).save()


def _writer(df: DataFrame, fmt: str, mode: str, options: dict | None, writers: int | None):
    if writers:
        df = df.repartition(int(writers))
    w = df.write.mode(mode).format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w


def current_version(spark: SparkSession, target: str) -> str | None:
    """The published version of a target, ``<root>/<type>``."""
    root, doc = os.path.split(target.rstrip("/"))
    return newest(spark, root)[1].get(doc)


def remove_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def remove_old_versions(spark: SparkSession, target: str, retain: int) -> list[str]:
    """Delete published versions but for the newest ``retain`` (at least the
    current one); unpublished ones, which may be in the making, stay."""
    root, doc = os.path.split(target.rstrip("/"))
    old = history(spark, root, doc)[max(1, retain):]
    for version in old:
        remove_folder(spark, version_path(target, version))
        remove_folder(spark, ledger_path(target, version))
    return old


def read_current(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    v = current_version(spark, target)
    if v is None:
        raise FileNotFoundError(f"no current version under {target}")
    return spark.read.format(fmt).load(version_path(target, v))


def duplicate_keys(df: DataFrame, key: str = "_id") -> DataFrame:
    """Keys that occur more than once (NULL keys count as a duplicate set)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
