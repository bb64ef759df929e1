"""Documents that share long lists are written small."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docsmith.sinks.writer import CODEC, write_documents


def _codec(path) -> set:
    files = glob.glob(os.path.join(str(path), "*.parquet"))
    return {pq.read_metadata(f).row_group(0).column(0).compression for f in files}


def test_documents_are_written_with_zstd(spark, tmp_path):
    df = spark.range(2000).coalesce(1).select("id", F.transform(F.sequence(F.lit(1), F.lit(997)),
                                                                lambda x: x * 7 + F.col("id") % 9).alias("sites"))
    write_documents(df, str(tmp_path / "z"))
    write_documents(df, str(tmp_path / "s"), options={"compression": "snappy"})
    assert (_codec(tmp_path / "z"), _codec(tmp_path / "s")) == ({"ZSTD"}, {"SNAPPY"})
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "z")).collect())) == sorted(map(str, df.collect()))


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_codec_of_the_session_and_other_formats_stay(spark, tmp_path, fmt):
    spark.conf.set(CODEC, "gzip")
    try:
        write_documents(spark.range(3).coalesce(1), str(tmp_path / fmt), fmt=fmt)
    finally:
        spark.conf.unset(CODEC)
    assert spark.read.format(fmt).load(str(tmp_path / fmt)).count() == 3
    assert fmt == "json" or _codec(tmp_path / fmt) == {"GZIP"}
