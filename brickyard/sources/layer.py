"""Columnar layer, summary sink and on-disk footprint.

Paths are Hadoop URIs (``file:``, ``hdfs:``, ``s3a:``…). Scratch output goes under the
session's checkpoint folder: the one set on the context if a caller set it there, else
the shared folder that the cluster names in ``spark.checkpoint.dir``. A private
temporary folder is used only with a local master and neither set (tests).
"""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOCAL_ROOT: str | None = None


def _plain(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:").rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder (see the module)."""
    global _LOCAL_ROOT
    named = spark.conf.get("spark.checkpoint.dir", None)
    held = spark.sparkContext.getCheckpointDir()      # a folder of its own under the one that was set
    if held and not (named and _plain(held).startswith(_plain(named))):
        return held.rstrip("/")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: working "
                           f"tables can't be kept in a machine's own folder under master {master}")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="brickyard-")
    return _LOCAL_ROOT


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there: one look-up, no listing."""
    return _file_system(spark, path)[0].exists(_file_system(spark, path)[1])


def state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the entries of a folder (one listing, not recursive)."""
    fs, place = _file_system(spark, path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(place)))


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put the finished folder ``staged`` in the place of ``path`` by renaming: readers see the old folder or the
    new one, never a half-written one, and a failed rename brings the old one back. (Where a store has no rename,
    e.g. plain object stores, both renames copy; give each run a path of its own there.)"""
    fs, new = _file_system(spark, staged)
    place, old = _file_system(spark, path)[1], _file_system(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")[1]
    had = fs.exists(place)
    if had and not fs.rename(place, old):
        raise RuntimeError(f"{path} could not be moved aside; it is unchanged")
    fs.mkdirs(place.getParent())
    done = False
    try:
        done = fs.rename(new, place)
    finally:
        if not done and had:
            fs.rename(old, place)
    if not done:
        raise RuntimeError(f"{staged} could not be published; {path} is as it was")
    if had:
        fs.delete(old, True)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, if it is there."""
    fs, place = _file_system(spark, path)
    fs.delete(place, True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the scratch root."""
    return f"{scratch_root(spark)}/brickyard/{label}-{uuid.uuid4().hex}"


def write_layer(df: DataFrame, path: str, *, partition_by: str | None = "year",
                compression: str = "snappy", layout: str = "rebalance",
                range_cluster: str | None = None) -> None:
    """Overwrite ``path`` with Parquet, partitioned by ``partition_by``.

    ``layout``:

    - ``"rebalance"`` (default) — the ``rebalance`` hint on the partition
      column: one shuffle, after which AQE splits large partitions and merges
      small ones to its advisory size, so every task writes one file of one
      partition value. Without it, input that is not already ordered by the
      partition column (e.g. the output of a join) makes every task write a
      file for every year it meets: tasks × years small files. Needs AQE; with
      AQE off it falls back to ``"map"`` rather than funnel each year into one
      task.
    - ``"map"`` — no shuffle; right for input already ordered by date (a
      chronological feed), where each split meets one or two years.
    - ``range_cluster`` (a column, e.g. ``"transfer_date"``) — a sampled range
      shuffle on (partition column, that column), for sorted files.
    """
    w = df
    aqe = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") == "true"
    if partition_by and range_cluster:
        w = df.repartitionByRange(partition_by, range_cluster)
    elif partition_by and layout == "rebalance" and aqe:
        w = df.hint("rebalance", partition_by)
    elif layout not in ("rebalance", "map"):
        raise ValueError(f"unknown layout {layout!r}")
    writer = w.write.mode("overwrite").option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def replace_years(df: DataFrame, path: str, years: Iterable[int], *, partition_by: str = "year",
                  compression: str = "snappy") -> None:
    """Overwrite the partitions of ``years`` of a stored layer with the rows of ``df`` and leave all others as they
    are (dynamic partition overwrite). Rows of other years raise before anything is written."""
    years = sorted(set(years))
    strays = df.where(~F.coalesce(F.col(partition_by).isin(*years), F.lit(False))).limit(1).count()
    if strays:
        raise ValueError(f"rows outside the years {years}")
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression)
       .partitionBy(partition_by).parquet(path))


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """Read a (partitioned) Parquet layer; partition columns are discovered.

    Select columns by name: partition columns come back at the end.
    """
    return spark.read.parquet(path)


def write_summary(df: DataFrame, path: str, *, single_file: bool = False,
                  name: str = "summary", limit: int | None = None) -> int:
    """Write a summary as CSV with a header and return its row count.

    The count is observed during the write itself (one job, no cache, no
    second pass). The observation sits in the write's result stage, where
    Spark applies each task's update once, so a retried task is not counted
    twice. ``single_file`` coalesces to one part file — only for
    summaries known to be small. ``limit`` (None or 0: no limit) caps the
    rows written, for callers that want a head of a sorted summary.
    """
    obs = Observation(f"{name}-{uuid.uuid4().hex}")     # unique: writes may run concurrently
    src = df.limit(limit) if limit else df
    out = src.observe(obs, F.count(F.lit(1)).alias("rows"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", "true").csv(path)
    return int(obs.get["rows"])


def read_summary(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a summary written by ``write_summary`` with its declared schema."""
    return spark.read.option("header", "true").schema(schema).csv(path)


def footprint_by(layer: DataFrame, by: str = "year") -> DataFrame:
    """Files, bytes and rows of a stored layer by a column that is constant within each file (its partition
    column): ``by``, ``files``, ``bytes``, ``rows``, from the hidden ``_metadata`` columns of the scan. No data
    column is read."""
    files = layer.groupBy(F.col("_metadata.file_path").alias("_path"), by).agg(
        F.first("_metadata.file_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    return files.groupBy(by).agg(F.count(F.lit(1)).alias("files"), F.sum("_bytes").alias("bytes"), F.sum("_rows").alias("rows"))


def footprint(spark: SparkSession, paths: dict[str, str], *, ratio_to: str | None = None) -> DataFrame:
    """Bytes and data files on disk per dataset: ``dataset``, ``files``, ``bytes``
    and, with ``ratio_to``, each dataset's size relative to that one (e.g. the
    CSV:Parquet compression ratio), 2 dp.

    Listed and summed by Spark (``binaryFile`` with only ``length`` selected,
    so file contents are never read); hidden files such as ``_SUCCESS`` and
    checksums are left out, so this is the size of the data itself.
    """
    parts = []
    for name, path in paths.items():
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .load(path).select("length"))
        parts.append(files.agg(F.count(F.lit(1)).alias("files"),
                               F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
                     .select(F.lit(name).alias("dataset"), "files", "bytes"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if ratio_to is not None:
        base = out.filter(F.col("dataset") == ratio_to).select("bytes").scalar()
        out = out.withColumn(f"ratio_to_{ratio_to}", F.round(F.try_divide(F.col("bytes"), base), 2))
    return out
