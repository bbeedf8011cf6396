"""Cell statistics: per-group median, row count and mean, with a thin-cell floor.

The exact median is the lower-middle element (rank ⌈n/2⌉ of the non-NULL values, NaN
last), the definition of ``percentile_disc(0.5)``. Three forms:

``method="counts"`` (default) — one scan. ``groupBy(keys, value)`` counts rows with
map-side combine, so what is shuffled are a group's distinct values, not its rows;
one window per group ranks them and gives the group's totals beside every value, and
the value that holds the rank is kept. Every group has exactly one such row, so none
can be lost. A whole-number price has bounded distinct values, whatever the rows.

``method="two_pass"`` — for fractional measures with about as many distinct values as
rows. Counts by (group, log-scale bucket of 1/256 octave) find each group's bucket and
the rank in it (a few thousand rows a group at most); a second scan keeps only that
bucket's values and ranks them. Both passes are one lazy plan; AQE chooses the join's
form by the selection's size. Totals come from the first pass; a group whose rows
change between the passes raises nothing but would be missing, so use it on stored data.

``method="approx"`` (or ``exact=False``) — ``percentile_approx(value, 0.5, accuracy)``:
a fixed-size sketch per group, merged map-side (one exchange). Equal to the exact
form on small cells; off by a bounded rank error on large ones.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.codes import MEDIAN_ACCURACY

ROWS = "transactions"
METHODS = ("counts", "two_pass", "approx")
BUCKETS_PER_OCTAVE = 256
_OFFSET = 1100 * BUCKETS_PER_OCTAVE          # above the bucket of the smallest double


def _names(measure: str, median_name: str | None, mean_name: str | None) -> tuple[str, str]:
    return (median_name or f"median_{measure}", mean_name or f"mean_{measure}")


def value_bucket(v: Column) -> Column:
    """Order-preserving log-scale bucket of a number: NULL for NULL, 0 for zero, NaN last.

    ``log2`` is evaluated with ``StrictMath`` (bit-exact on every platform), so both
    passes agree on every executor."""
    x = v.cast("double")
    size = F.floor(F.log2(F.abs(x)) * F.lit(float(BUCKETS_PER_OCTAVE))) + F.lit(_OFFSET)
    return (F.when(F.isnan(x), F.lit(2 * _OFFSET + BUCKETS_PER_OCTAVE))
            .when(x == 0, F.lit(0)).when(x > 0, F.least(size, F.lit(2 * _OFFSET)))
            .when(x < 0, -F.least(size, F.lit(2 * _OFFSET)))).cast("long")


def _mean_of(total: Column, n: Column, integral: bool) -> Column:
    """Mean; truncated to a whole number (as ``cast(long)``) for integral
    measures, left as a double for fractional ones."""
    m = F.try_divide(total, n)
    return m.cast("long") if integral else m


def _integral(df: DataFrame, measure: str) -> bool:
    return isinstance(df.schema[measure].dataType, IntegralType)


def _same_keys(keys: list[str], prefix: str) -> Column | None:
    if not keys:
        return None
    return reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(keys)])


def _ranked(counts: DataFrame, keys: list[str], value: str, total: Column) -> DataFrame:
    """Counts by (keys, value) with, beside each value, the rows up to it (``_cum``), the
    group's rows, non-NULL rows and sum; one window, NULL last."""
    valued = F.when(F.col(value).isNotNull(), F.col("_n")).otherwise(F.lit(0))
    spec = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    upto = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.withColumn("_vn", valued).withColumns({
        "_cum": F.sum("_vn").over(upto), "_valued": F.sum("_vn").over(whole),
        "_rows": F.sum("_n").over(whole), "_total": F.sum(total).over(whole)})


def _holds_rank(rank: Column, cum: str = "_cum", n: str = "_vn") -> Column:
    return (F.col(cum) >= rank) & (F.col(cum) - F.col(n) < rank)


def _counts(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    counts = df.groupBy(*keys, F.col(measure).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    out = _ranked(counts, keys, "_v", F.col("_v").cast("double") * F.col("_n"))
    rank = F.ceil(F.col("_valued") / F.lit(2))
    none = (F.col("_valued") == 0) & F.col("_v").isNull()
    return out.filter((F.col("_v").isNotNull() & _holds_rank(rank)) | none).select(
        *keys, F.col("_v").alias("_median"), "_rows", "_total", "_valued")


def _two_pass(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    v = F.col(measure)
    coarse = df.groupBy(*keys, value_bucket(v).alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(v.cast("double")).alias("_s"))
    coarse = _ranked(coarse, keys, "_b", F.col("_s"))
    rank = F.ceil(F.col("_valued") / F.lit(2))
    names = [f"_g{i}" for i in range(len(keys))]
    none = (F.col("_valued") == 0) & F.col("_b").isNull()
    chosen = coarse.filter((F.col("_b").isNotNull() & _holds_rank(rank)) | none).select(
        *[F.col(k).alias(g) for k, g in zip(keys, names, strict=True)], F.col("_b").alias("_sb"),
        (rank - (F.col("_cum") - F.col("_vn"))).alias("_k"), "_rows", "_total", "_valued")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(g)) for k, g in zip(keys, names, strict=True)],
                  F.col("_sb").eqNullSafe(value_bucket(v)))
    inside = chosen.join(df.select(*keys, measure), same, "left").groupBy(
        *names, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"),
                                   *[F.first(c).alias(c) for c in ("_k", "_rows", "_total", "_valued")])
    upto = Window.partitionBy(*names).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_cum2", F.sum("_n").over(upto))
    return inside.filter(_holds_rank(F.col("_k"), "_cum2", "_n") | (F.col("_valued") == 0)).select(
        *[F.col(g).alias(k) for k, g in zip(keys, names, strict=True)], F.col("_v").alias("_median"),
        "_rows", "_total", "_valued")


def _exact(df: DataFrame, keys: list[str], measure: str, median: str, mean: str | None,
           method: str) -> DataFrame:
    out = (_counts if method == "counts" else _two_pass)(df, keys, measure)
    cols = [*keys, F.col("_median").alias(median), F.col("_rows").alias(ROWS)]
    if mean is not None:
        cols.append(_mean_of(F.col("_total"), F.col("_valued"), _integral(df, measure)).alias(mean))
    if not keys:                             # one row even over no rows
        out = out.agg(F.first("_median").alias("_median"), F.coalesce(F.first("_rows"), F.lit(0)).alias("_rows"),
                      F.first("_total").alias("_total"), F.coalesce(F.first("_valued"), F.lit(0)).alias("_valued"))
    return out.select(*cols)


def _approx(df: DataFrame, keys: list[str], measure: str, median: str, mean: str | None,
            accuracy: int) -> DataFrame:
    aggs: list[Column] = [
        F.percentile_approx(measure, 0.5, accuracy).alias(median),
        F.count(F.lit(1)).alias(ROWS),
    ]
    if mean is not None:
        avg = F.avg(measure)
        aggs.append((avg.cast("long") if _integral(df, measure) else avg).alias(mean))
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def cell_stats(df: DataFrame, keys: Sequence[str], measure: str = "price", *,
               min_rows: int | None = None, exact: bool = True, method: str = "counts",
               with_mean: bool = True, accuracy: int = MEDIAN_ACCURACY,
               median_name: str | None = None, mean_name: str | None = None) -> DataFrame:
    """One row per group of ``keys``: ``median_<measure>``, ``transactions``
    (all rows of the group) and, if asked, ``mean_<measure>`` (the mean of the
    non-NULL values; for integral measures truncated to a whole number, as
    ``cast(long)`` does).

    ``min_rows`` suppresses thin cells (HAVING ``transactions >= min_rows``).
    NULL keys form their own group, as in ``groupBy``. ``method``: see the module.
    """
    keys = list(keys)
    if method not in METHODS:
        raise ValueError(f"unknown median method {method!r}")
    median, mean = _names(measure, median_name, mean_name)
    mean = mean if with_mean else None
    if not exact or method == "approx":
        out = _approx(df, keys, measure, median, mean, accuracy)
    else:
        out = _exact(df, keys, measure, median, mean, method)
    out = out.select(*keys, median, ROWS, *([mean] if mean else []))
    if min_rows is not None:
        out = out.filter(F.col(ROWS) >= min_rows)
    return out


def median_by(df: DataFrame, keys: Sequence[str], measure: str = "price", *,
              exact: bool = True, method: str = "counts", accuracy: int = MEDIAN_ACCURACY,
              order: bool = False, median_name: str | None = None) -> DataFrame:
    """Median and row count per group (no floor); optionally sorted by keys."""
    out = cell_stats(df, keys, measure, exact=exact, method=method, with_mean=False, accuracy=accuracy,
                     median_name=median_name)
    return out.orderBy(*keys) if order else out
