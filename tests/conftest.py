import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from docsmith.session import build_session
    scratch = tempfile.mkdtemp(prefix="docsmith-test-")
    s = build_session("local[4]", 4, extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def empty_catalogue(spark):
    """Every catalogue table, empty, with the adapter's columns, all nullable."""
    from pyspark.sql.types import StructField, StructType
    from docsmith.sources.adapter import ADAPTER_SQL
    from docsmith.sources.catalogue import Catalogue
    base = Catalogue.from_adapter(spark, SF0001)
    return {n: spark.createDataFrame([], StructType(
        [StructField(f.name, f.dataType, True) for f in base[n].schema])) for n in ADAPTER_SQL}


@pytest.fixture
def make_cat(spark, empty_catalogue):
    """Catalogue with some tables replaced by hand-built rows."""
    from docsmith.sources.catalogue import Catalogue

    def make(**rows):
        frames = dict(empty_catalogue)
        for name, data in rows.items():
            frames[name] = spark.createDataFrame(data, empty_catalogue[name].schema)
        return Catalogue.from_frames(spark, frames)
    return make
