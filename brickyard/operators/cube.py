"""A stored cube of counts, and exact percentiles of every key set rolled up from it.

``write_counts`` is the one pass over the layer: rows by (dimensions, measure), combined
map-side, stored by year. ``write_percentiles`` reads only that table: one ``GROUPING SETS``
aggregate adds the counts up for all key sets at once, one window ranks each group's values,
and of these are kept the rows that hold a percentile rank ⌈k·n/100⌉, k = 1…100. A group
thus has at most 100 stored rows, whatever its size, each with its exact value, and its
rows, non-NULL rows and sum beside it; the median is the row of k = 50, the definition of
``percentile_disc(0.5)``. A query over ``cells`` is a pruned scan with a filter: no
exchange, no sort.

The cube costs one aggregate of the layer and one of the cube at ingest (``bench.py`` gives
the seconds as ``price_cube``). A new or corrected year replaces its own partition of the
counts (``years``); the layer's other years aren't read again. Attributes of a dimension
that a key set needs (region of an area) are joined to the counts, not to rows.

NULL keys form groups of their own; NULL values count in ``transactions`` only and NaN
ranks last, as in ``cells``.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cells import ROWS, _integral, _mean_of, _ranked
from .dimension import enrich_join
from .profile import share_pct

DIMENSIONS = ("district", "postcode_area", "property_type_name", "is_new_build", "year", "quarter")
#: Key sets whose percentiles are stored, by name.
SETS: dict[str, tuple[str, ...]] = {
    "all": (),
    "year": ("year",),
    "quarter": ("year", "quarter"),
    "district": ("district", "year"),
    "district_type": ("district", "property_type_name", "year"),
    "area": ("postcode_area", "year"),
    "cohort": ("year", "property_type_name", "is_new_build"),
    "region": ("region", "year"),
}
GRID = 100
_STORED = ["rows", "valued", "total", "upto", "n"]


def counts(df: DataFrame, dims: Sequence[str] = DIMENSIONS, measure: str = "price") -> DataFrame:
    """Rows by (``dims``, ``measure``) as ``n``."""
    return df.groupBy(*dims, measure).agg(F.count(F.lit(1)).alias("n"))


def write_counts(df: DataFrame, path: str, *, dims: Sequence[str] = DIMENSIONS, measure: str = "price",
                 period: str = "year", years: Iterable[int] | None = None) -> None:
    """Store ``counts`` under ``path``, partitioned by ``period``. With ``years``, only these
    years are counted and their partitions replaced (all others stay)."""
    if years is not None:
        df = df.where(F.col(period).isin(*list(years)))
    writer = counts(df, dims, measure).write.mode("overwrite").partitionBy(period)
    if years is not None:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def grouping_mark(dims: Sequence[str], keys: Sequence[str]) -> int:
    """``grouping_id()`` over ``dims`` of a row grouped by ``keys``: a bit for every dimension left out."""
    return sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in keys)


def percentiles(cube: DataFrame, sets: Mapping[str, Sequence[str]] = SETS, *, measure: str = "price",
                grid: int = GRID) -> DataFrame:
    """For every key set the rows that hold a rank ⌈k·n/grid⌉ of their group: ``key_set``, the keys
    (NULL where not of the set), the measure, ``rows``, ``valued``, ``total``, ``upto`` (non-NULL rows
    up to the value) and ``n`` (those of the value)."""
    dims = list(dict.fromkeys(k for keys in sets.values() for k in keys))
    marks = {grouping_mark([*dims, measure], [*keys, measure]): name for name, keys in sets.items()}
    if len(marks) < len(sets):
        raise ValueError("two key sets have the same keys")
    name = F.element_at(F.create_map(*[F.lit(x) for pair in marks.items() for x in pair]), F.grouping_id().cast("int"))
    grouped = cube.groupingSets([[*keys, measure] for keys in sets.values()], *dims, measure).agg(
        F.sum("n").alias("_n"), name.alias("key_set"))
    out = _ranked(grouped, ["key_set", *dims], measure, F.col(measure).cast("double") * F.col("_n"))

    def ranks(upto):                     # ranks of the grid at or below a position
        return F.floor(upto * F.lit(grid) / F.col("_valued"))

    holds = F.col(measure).isNotNull() & (ranks(F.col("_cum")) > ranks(F.col("_cum") - F.col("_vn")))
    none = (F.col("_valued") == 0) & F.col(measure).isNull()
    return out.where(holds | none).select(
        "key_set", *dims, measure, F.col("_rows").alias("rows"), F.col("_valued").alias("valued"),
        F.col("_total").alias("total"), F.col("_cum").alias("upto"), F.col("_vn").alias("n"))


class Cube:
    """The stored tables under a folder; each is opened when it is first asked for."""

    def __init__(self, spark: SparkSession, path: str, sets: Mapping[str, Sequence[str]] = SETS, measure: str = "price"):
        self.spark, self.path, self.sets, self.measure = spark, path, sets, measure

    @cached_property
    def counts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/counts")

    @cached_property
    def percentiles(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/percentiles")

    def cells(self, key_set: str, *, percent: int = 50, min_rows: int | None = None, with_mean: bool = False) -> DataFrame:
        """One row per group of the key set, as ``cell_stats`` gives them: the keys, ``median_<measure>`` (or
        ``p<percent>_<measure>``), ``transactions`` and, if asked, ``mean_<measure>``."""
        if not 1 <= percent <= GRID:
            raise ValueError(f"percent must be from 1 to {GRID}")
        keys = list(self.sets[key_set])
        rank = F.ceil(F.col("valued") * F.lit(percent) / F.lit(GRID))
        holds = (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank) | (F.col("valued") == 0)
        value = f"median_{self.measure}" if percent == 50 else f"p{percent}_{self.measure}"
        out = self.percentiles.where((F.col("key_set") == key_set) & holds)
        if min_rows is not None:
            out = out.where(F.col("rows") >= min_rows)
        mean = _mean_of(F.col("total"), F.col("valued"), _integral(self.percentiles, self.measure))
        return out.select(*keys, F.col(self.measure).alias(value), F.col("rows").alias(ROWS),
                          *([mean.alias(f"mean_{self.measure}")] if with_mean else []))

    def headline(self) -> DataFrame:
        """As ``profile.headline``, from the counts and the stored percentiles."""
        out = self.counts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.min("year").alias("year_min"), F.max("year").alias("year_max"),
            F.count_distinct("district").alias("districts"), F.count_distinct("postcode_area").alias("postcode_areas"))
        return out.withColumn(f"median_{self.measure}_all_time", self.cells("all").select(f"median_{self.measure}").scalar())

    def skew(self, key: str = "postcode_area", top_n: int = 10) -> DataFrame:
        """As ``profile.skew_profile``, from the counts."""
        grouped = self.counts.groupBy(key).agg(F.sum("n").alias("rows"))
        total = grouped.agg(F.sum("rows")).scalar()
        top = grouped.orderBy(F.desc("rows"), F.asc_nulls_first(key)).limit(top_n)
        return top.withColumn("pct_of_total", share_pct("rows", total, 3))


def build_cube(df: DataFrame, path: str, *, dim: DataFrame | None = None, key: str = "postcode_area",
               sets: Mapping[str, Sequence[str]] = SETS, measure: str = "price", years: Iterable[int] | None = None) -> Cube:
    """Store counts and percentiles of ``df`` under ``path``. ``dim``: a dimension by ``key`` whose attributes
    key sets use. ``years``: count only these again."""
    spark = df.sparkSession
    write_counts(df, f"{path}/counts", measure=measure, years=years)
    table = spark.read.parquet(f"{path}/counts")
    if dim is not None:
        table = enrich_join(table, dim, key)
    percentiles(table, sets, measure=measure).write.mode("overwrite").partitionBy("key_set").parquet(f"{path}/percentiles")
    return read_cube(spark, path, sets=sets, measure=measure)


def read_cube(spark: SparkSession, path: str, *, sets: Mapping[str, Sequence[str]] = SETS, measure: str = "price") -> Cube:
    return Cube(spark, path, sets, measure)
