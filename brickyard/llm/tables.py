"""Working tables: written under the checkpoint folder, bucketed by range, broadcast behind a check."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.layer import scratch_dir

BROADCAST_BYTES = 32 << 20       # most that a broadcast side may hold, by rows times row width


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet under the session's checkpoint folder and
    read back: lineage ends here and every executor can read it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _files_only(df: DataFrame) -> bool:
    """Whether each row of ``df`` is a row of one scan of files: nothing but projections and filters above it."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.child()
    return node.nodeName() == "LogicalRelation"


def numbered(df: DataFrame, name: str, label: str, *columns: Column) -> DataFrame:
    """``columns`` of ``df`` (all, if none are given) and ``name``, a row number that every
    scan gives again: the number of the row's file and its place there, where ``df`` is a
    scan of one file or of files that one Spark write numbered; else from a written copy."""
    columns = columns or ("*",)
    if _files_only(df) and "_metadata" not in (c.lower() for c in df.columns):
        files = [f.rsplit("/", 1)[-1] for f in df.inputFiles()]
        parts = [m and m[1] for m in (re.match(r"part-(\d+)-[^/]*\.parquet$", f) for f in files)]
        place = F.col("_metadata.row_index")
        if len(files) == 1 and files[0].endswith(".parquet"):
            return df.select(*columns, place.alias(name))
        if files and all(parts) and len(set(parts)) == len(parts):
            file = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-", 1).cast("long")
            return df.select(*columns, (F.shiftleft(file, 40) + place).alias(name))
    return written(df.select(*columns, F.monotonically_increasing_id().alias(name)), label)


def small(table: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """``table`` (a written one: its count is read from file footers) marked for
    broadcast if it is proven to hold at most ``most`` bytes; else left to a
    shuffled join, which AQE splits where keys are hot."""
    return F.broadcast(table) if table.count() * row_bytes <= most else table


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def blocks(spark: SparkSession) -> int:
    """Number of hash blocks that a working table is dealt into: some to each
    shuffle partition, so that partitions come out even and a block stays small."""
    return min(1 << 16, 8 * partitions(spark))


def range_bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """Ascending values of ``key`` that start up to ``n`` ranges of about equal
    row counts. Each is a value of the column; the first is the least one. Empty
    where the column has no value. (The driver holds ``n`` numbers.)"""
    steps = [i / n for i in range(1, n)] or [0.5]
    row = df.select(F.min(key).alias("least"), F.percentile_approx(key, steps, 10 * n).alias("mid")).first()
    if row is None or row["least"] is None:
        return []
    return sorted({int(row["least"]), *map(int, row["mid"])})


def ranges_for(df: DataFrame, key: str, rows: int, most: int = 1 << 18) -> list[int]:
    """``range_bounds`` for ranges of about ``rows`` rows each."""
    return range_bounds(df, key, max(1, min(most, -(-df.count() // rows))))


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of the range that ``key`` lies in, 0 to ``len(bounds) - 1``; NULL
    keys follow the last range."""
    if len(bounds) < 2:
        found = F.lit(0)
    else:                            # first among every 64th bound, then within
        value = key.cast("long")
        every = F.array(*[F.lit(int(b)).cast("long") for b in bounds])
        coarse = F.array(*[F.lit(int(b)).cast("long") for b in bounds[::64]])
        block = F.greatest(F.size(F.filter(coarse, lambda b: b <= value)) - 1, F.lit(0))
        found = F.greatest(block * 64 + F.size(F.filter(F.slice(every, block * 64 + 1, 64), lambda b: b <= value)) - 1, F.lit(0))
    return F.when(key.isNull(), F.lit(max(0, len(bounds) - 1))).otherwise(found).cast("int")
