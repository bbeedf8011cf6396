"""Profiles: headline scalars and key-skew.

Both are single aggregates that return one small DataFrame; nothing is
collected inside the operator.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import share_pct
from .cells import cell_stats


def headline(df: DataFrame, *, period: str = "year", entities: tuple[str, ...] = ("district",
             "postcode_area"), measure: str | None = "price", exact: bool = True) -> DataFrame:
    """One row: ``total_rows``, ``year_min``, ``year_max``, a distinct count
    per entity column (``districts``, ``postcode_areas``) and, when ``measure``
    is given, the all-time median ``median_price_all_time``.

    The scalars are one aggregate (Catalyst expands the distinct counts);
    the median is attached as a scalar subquery, so the answer stays one row
    without a join.
    """
    names = {"district": "districts", "postcode_area": "postcode_areas"}
    out = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min(period).alias(f"{period}_min"),
        F.max(period).alias(f"{period}_max"),
        *[F.count_distinct(e).alias(names.get(e, f"{e}_distinct")) for e in entities],
    )
    if measure is not None:
        med = cell_stats(df, [], measure, exact=exact, with_mean=False, median_name="_m")
        out = out.withColumn(f"median_{measure}_all_time", med.select("_m").scalar())
    return out


def skew_profile(df: DataFrame, key: str = "postcode_area", top_n: int = 10) -> DataFrame:
    """Top ``top_n`` keys by row count with their share of all rows (3 dp).

    NULL is a key like any other. The total is a scalar subquery over the
    grouped counts (partial sums, one value), not an eager ``count()`` job nor
    a window over all groups in one task. Ties are broken by key.
    """
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = grouped.agg(F.sum("rows").alias("_total")).scalar()
    top = grouped.orderBy(F.desc("rows"), F.asc_nulls_first(key)).limit(top_n)
    return top.withColumn("pct_of_total", share_pct("rows", total, 3))
