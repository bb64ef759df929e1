"""Physical layout for repeated rebuilds: the catalogue bucketed by item key.

A rebuild aggregates every relation by the item key and joins the results
on it.  When the relation tables are stored bucketed by that key (same
bucket count everywhere), the aggregations and the joins find their input
already partitioned: no relation is shuffled by the rebuild.  Writing the
bucketed copy costs one shuffle per table, once; every later rebuild reads
it.  Small lookup tables are copied as they are.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..params import REBUILD_ORDER
from ..session import shuffles_released
from .catalogue import Catalogue, from_catalog

#: Tables that are written at once.
WRITERS = 3


def item_keys(docs=REBUILD_ORDER, params=None, options=None) -> dict[str, str]:
    """Catalogue table -> the column holding the item key it is joined on: every root
    and every relation of an item, those of songs (by album or by song) included."""
    from ..plans.specs import spec_for
    keys: dict[str, str] = {}
    for doc in docs:
        spec = spec_for(doc, params, options)
        # songs are joined to their albums by the album id, so that is their layout
        own = {root: mine for j in spec.root_joins for mine, root in j.on} if spec.root_joins else {}
        keys.setdefault(spec.root, own.get("id", "id"))
        # columns of the joined tables that hold an item id, by their names in the document
        items = {"id"} | {new for j in spec.root_joins for col, new in j.select if col == "id"}
        for b in spec.branches + ((spec.legacy_dup,) if spec.legacy_dup else ()):
            if b.root_ref in items:
                keys.setdefault(b.table, b.key)
    return keys


def bucket_catalogue(spark: SparkSession, cat: Catalogue, database: str, root: str,
                     buckets: int, docs=REBUILD_ORDER, params=None, options=None) -> Catalogue:
    """Write every catalogue table under ``root`` as a table of ``database``,
    item-keyed ones bucketed (and sorted) by their key; return the catalogue
    over the written tables."""
    keys = item_keys(docs, params, options)
    names = cat.names()
    frames = {name: cat[name] for name in names}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{os.path.join(root, '_db')}'")

    def write(name: str) -> None:
        df = frames[name]
        if name in keys:
            # one task, and so one file, per bucket.  The writer sorts by the bucket and the key,
            # computing the bucket in every comparison; rows that come in the order of the key
            # it only passes through.  A sort under its own would be left out but for observe().
            df = df.repartition(buckets, keys[name]).sortWithinPartitions(keys[name]) \
                .observe(Observation(), F.count(F.lit(1)).alias("n"))
        w = df.write.mode("overwrite").format("parquet").option("path", os.path.join(root, name))
        if name in keys:
            w = w.bucketBy(buckets, keys[name]).sortBy(keys[name])
        w.saveAsTable(f"{database}.{name}")

    # a few at a time: the last tasks of one table leave cores to the next
    with shuffles_released(spark), ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(write, names))
    return from_catalog(spark, database, names)
