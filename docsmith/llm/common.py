"""Helpers shared by the operators: staged tables, row keys, word rules.

Staged tables cut lineage with a written Parquet table in the folder that
the cluster names in ``spark.checkpoint.dir``: a lost executor costs a
re-read, never a recomputation, and Catalyst knows the size of what it reads.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsmith.session import checkpoint_dir

#: White space between words, in the contracts' words `[^\x20\x09-\x0D]+`.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows of one Arrow batch handed to Python: bounds memory when texts are long.
BATCH_ROWS = 500

_STAGED: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession) -> int:
    """Delete the tables staged by this driver; results that were not yet
    written must not be read after it."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    n = 0
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def python_workers(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Settings for operators that run Python.  Batches hold at most ``rows`` rows:
    the default of 10,000 long texts would not fit a worker; a caller's smaller
    setting stays.  Workers that see this machine's files find the package where
    the driver found it (elsewhere it is shipped with the job)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    environment = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def packed(df: DataFrame) -> DataFrame:
    """The whole row as one column ``_in``: whatever its columns are named, they
    cannot clash with an operator's own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_in"))


def field(name: str) -> Column:
    return F.col("_in").getField(name)


def unpacked(columns: list[str]) -> list[Column]:
    return [field(c).alias(c) for c in columns]


def row_key(columns: list[str]) -> list[Column]:
    """The content key (k1, k2) of a packed row."""
    return content_key(*[field(c).cast("string") for c in columns])


def text_or_empty(column: str | Column = "text") -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def content_key(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes (k1, k2) of the given columns: the identity
    of a row's content.  Rows of equal content share it and any result that
    depends on the content alone."""
    return [F.xxhash64(*columns).alias("k1"),
            F.xxhash64(F.lit("second"), *columns).alias("k2")]


def numbered(staged_rows: DataFrame, keys: list[str], block: int = 4096) -> DataFrame:
    """Staged rows with ``copy``: 1, 2, ... among the rows that are equal in ``keys``.
    Which of the equal rows has which number depends on the files, the numbers do
    not.  A group of copies is numbered in blocks of at most ``block`` rows, so no
    task holds a hot one."""
    columns = staged_rows.columns
    rows = staged_rows.withColumn("_uid", F.monotonically_increasing_id()).withColumn(
        "_block", F.expr(f"_uid div {block}"))
    at = [*keys, "_block"]
    inside = W.partitionBy(*at).orderBy("_uid")
    earlier = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sizes = rows.groupBy(*at).count().withColumn(
        "_before", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    sizes = sizes.select(*[F.col(c).alias(f"_of{c}") for c in at], "_before")
    same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in at]
    return rows.withColumn("_rank", F.row_number().over(inside)).join(sizes, same) \
        .withColumn("copy", (F.col("_before") + F.col("_rank")).cast("long")).select(*columns, "copy")


def words(column: Column) -> Column:
    """Words of the contracts' rule, as an array without empty strings."""
    return F.array_remove(F.split(column, r"[\x20\x09-\x0D]+"), "")


def word_count(column: Column) -> Column:
    return F.size(words(column)).cast("long")
