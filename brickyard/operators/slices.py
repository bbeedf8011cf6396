"""Period slices that keep predicates pushable.

A filter on a partition column prunes directories; a filter written as
``year(ts) = k`` is opaque to the Parquet reader (only ``IsNotNull`` reaches
it), so a year on a timestamp column is expressed as the half-open range
``[k-01-01, (k+1)-01-01)``, which the reader receives as two comparisons.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def year_range(df: DataFrame, ts: str, first: int, last: int | None = None) -> Column:
    """``first-01-01 <= ts < (last+1)-01-01`` with literals of ``ts``'s own type."""
    last = first if last is None else last
    t = df.schema[ts].dataType
    lo = F.lit(f"{first:04d}-01-01 00:00:00").cast(t)
    hi = F.lit(f"{last + 1:04d}-01-01 00:00:00").cast(t)
    return (F.col(ts) >= lo) & (F.col(ts) < hi)


def period_slice(df: DataFrame, period: str = "year", *, years: Iterable[int] | None = None,
                 since: int | None = None, equals: int | None = None, table: DataFrame | None = None) -> DataFrame:
    """Keep rows whose period is in ``years``, ``>= since``, ``== equals`` or a value of ``table``'s column
    ``period``: a filtered table of periods, at most as many rows as the layer has partitions. It is broadcast, and
    its values prune the layer's partitions before they are read (dynamic partition pruning)."""
    p = F.col(period)
    if table is not None:
        df = df.join(F.broadcast(table.select(period)), period, "left_semi")
    if years is not None:
        df = df.filter(p.isin(*list(years)))
    if since is not None:
        df = df.filter(p >= since)
    if equals is not None:
        df = df.filter(p == equals)
    return df


def year_slice_counts(df: DataFrame, year: int, *, by: str, period: str | None = None,
                      ts: str | None = None) -> DataFrame:
    """Rows per ``by`` value within one year: ``by``, ``rows``.

    Give ``period`` for an integer (partition) column, or ``ts`` for a
    timestamp column (turned into a pushable range).
    """
    if period is not None:
        df = df.filter(F.col(period) == year)
    elif ts is not None:
        df = df.filter(year_range(df, ts, year))
    else:
        raise ValueError("give period or ts")
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
