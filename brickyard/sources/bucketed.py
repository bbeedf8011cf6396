"""A layer bucketed and sorted by a join key: the merge join of such a layer shuffles no fact rows.

Rows with a key are stored as a bucketed, sorted table of the session's catalog; rows without one
can't match, so they are stored apart and never pile into the bucket that NULL hashes to. The
dimension is written with the same buckets. Their number grows with the rows, so that the sort of a
bucket stays in a task's memory. ``join_bucketed`` then joins bucket by bucket, without
an exchange or a sort of the fact where a bucket is one file, and adds the rows without a key.

One hot key stays in one bucket: for a key that holds a large share of the rows use
``enrich_join(strategy="merge", hot_share=…)``, which salts it, or broadcast the dimension.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BUCKET_ROWS = 1_000_000          # a task sorts a bucket: its rows stay in memory
MOST_BUCKETS = 10_000            # files of one write


@dataclass(frozen=True)
class Bucketed:
    """Names and places of a bucketed layer."""

    table: str
    rest: str
    key: str
    buckets: int


def _save(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    # one task a bucket, so that a bucket is one sorted file
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def write_bucketed(df: DataFrame, path: str, key: str, *, buckets: int, bucket_rows: int = BUCKET_ROWS) -> Bucketed:
    """Store ``df`` under ``path``, bucketed and sorted by ``key``: in ``buckets`` buckets, or in as many as hold
    ``bucket_rows`` rows each on average, if these are more."""
    keyed = df.where(F.col(key).isNotNull())
    buckets = max(buckets, min(MOST_BUCKETS, -(-keyed.select(key).count() // bucket_rows)))
    made = Bucketed(f"bucketed_{uuid.uuid4().hex}", f"{path}/without_key", key, buckets)
    _save(keyed, made.table, f"{path}/rows", key, buckets)
    df.where(F.col(key).isNull()).write.mode("overwrite").parquet(made.rest)
    return made


def join_bucketed(spark: SparkSession, layer: Bucketed, dim: DataFrame, path: str, *columns: str) -> DataFrame:
    """Left join of a bucketed layer (its ``columns``, all if none) to ``dim``, which is stored under ``path`` with the same buckets."""
    name = f"bucketed_{uuid.uuid4().hex}"
    _save(dim, name, path, layer.key, layer.buckets)
    fact, rest = spark.table(layer.table), spark.read.parquet(layer.rest)
    if columns:
        fact, rest = fact.select(*columns), rest.select(*columns)
    joined = fact.join(spark.table(name).hint("merge"), layer.key, "left")
    own = {f.name: F.lit(None).cast(f.dataType) for f in dim.schema if f.name != layer.key}
    return joined.unionByName(rest.withColumns(own))
