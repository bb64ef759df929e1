"""Where the catalogue tables come from.

A ``Catalogue`` maps catalogue table names to DataFrames, created lazily so
that a document only scans the tables it uses.  Three constructors:

* ``from_adapter(spark, sf_dir)`` - the test catalogue projected from the
  driver's parquet tables (see ``adapter.py``);
* ``from_parquet(spark, root)`` - one parquet folder per catalogue table;
* ``from_jdbc(spark, url, ...)`` - the live relational database.

Every DataFrame is a plain lazy read, so Catalyst prunes columns and pushes
filters (including a segment's id range) into each scan.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..params import REBUILD_ORDER
from .adapter import ADAPTER_SQL, base_tables_of, spark_text


#: Collation of text compared without regard to case.
NO_CASE = "UTF8_LCASE"


def plain(col: Column) -> Column:
    """Text as bytes, whatever its collation."""
    return F.collate(col, "UTF8_BINARY")


def collated(df: DataFrame, collation: str) -> DataFrame:
    """``df`` with every text column collated."""
    return df.select(*[F.collate(F.col(f"`{f.name}`"), collation).alias(f.name)
                       if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


class Catalogue:
    def __init__(self, spark: SparkSession, loaders: dict[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}
        self.measured: dict = {}   # sizes that a plan was chosen by

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._loaders:
                raise KeyError(f"catalogue has no table {name!r}")
            self._frames[name] = self._loaders[name]()
        return self._frames[name]

    def __contains__(self, name: str) -> bool:
        return name in self._loaders

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def with_table(self, name: str, df: DataFrame) -> "Catalogue":
        loaders = dict(self._loaders)
        loaders[name] = lambda: df
        return Catalogue(self.spark, loaders)

    def collated(self, collation: str) -> "Catalogue":
        """The same tables with every text column in ``collation``: all comparisons,
        joins and groups of text follow it.  Such a comparison is not pushed into a
        scan."""
        return Catalogue(self.spark, {n: (lambda n=n: collated(self[n], collation))
                                      for n in self._loaders})

    # ---- constructors -------------------------------------------------------

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> "Catalogue":
        return cls(spark, {n: (lambda d=d: d) for n, d in frames.items()})

    @classmethod
    def from_adapter(cls, spark: SparkSession, sf_dir: str) -> "Catalogue":
        base: dict[str, DataFrame] = {}

        def read_base(t: str) -> DataFrame:
            if t not in base:
                base[t] = spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet"))
            return base[t]

        def loader(name: str) -> Callable[[], DataFrame]:
            sql = ADAPTER_SQL[name]
            return lambda: spark.sql(spark_text(sql), **{t: read_base(t) for t in base_tables_of(sql)})

        return cls(spark, {n: loader(n) for n in ADAPTER_SQL})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names=None, params=None,
                     options=None) -> "Catalogue":
        """One folder per table; by default the tables that ``params`` names."""
        names = names or tables_of(params=params, options=options)
        return cls(spark, {n: (lambda n=n: spark.read.parquet(os.path.join(root, n))) for n in names})

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, properties: dict, names=None,
                  fetchsize: int = 100, partitions: int = 1, params=None, options=None) -> "Catalogue":
        """JDBC catalogue, by default of the tables that ``params`` names.  With
        ``partitions`` over 1 each table that has a document key is read over so many
        connections, in ranges of that key with about equal row counts: a histogram
        is asked of the database when the table is first used.  A key that alone holds
        more than a range's share is a range of its own."""
        from .layout import item_keys
        from .ranges import cut_ranges, equi_depth_cuts
        names = names or tables_of(params=params, options=options)
        props = {k: str(v) for k, v in properties.items()}
        props.setdefault("fetchsize", str(fetchsize))
        keys = item_keys(params=params, options=options) if partitions > 1 else {}

        def ask(sql: str) -> list:
            return [tuple(r) for r in spark.read.jdbc(url, f"({sql}) asked", properties=props).collect()]

        def read(n: str) -> DataFrame:
            if n not in keys:
                return spark.read.jdbc(url, n, properties=props)
            cuts = equi_depth_cuts(ask, n, keys[n], partitions)
            return spark.read.jdbc(url, n, predicates=cut_ranges(cuts, keys[n]), properties=props)

        return cls(spark, {n: (lambda n=n: read(n)) for n in names})


def tables_of(docs=REBUILD_ORDER, params=None, options=None) -> list[str]:
    """The catalogue tables that the documents read, by their configured names."""
    from ..plans.specs import spec_for
    found: set[str] = set()
    for doc in docs:
        spec = spec_for(doc, params, options)
        found |= {spec.root, *[j.table for j in spec.root_joins]}
        for b in spec.branches + ((spec.legacy_dup,) if spec.legacy_dup else ()):
            found |= {b.table, *[j.table for j in b.joins]}
    return sorted(found)


def from_catalog(spark: SparkSession, database: str, names) -> Catalogue:
    """Catalogue tables registered in the session catalog (e.g. bucketed
    tables written by ``layout.bucket_catalogue``)."""
    return Catalogue(spark, {n: (lambda n=n: spark.table(f"{database}.{n}")) for n in names})
