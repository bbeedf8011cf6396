"""Trends over (entity, period) cells: prior period, baseline change, rolling mean.

All frames are *range* frames over a numeric period, so a missing period is a
gap (NULL prior, narrower rolling sample), never a silent step to the previous
surviving row as ``lag`` would take. Every frame here shares one window
specification (partition by entity, order by the long period), so the plan
holds one ``Sort`` and one ``Window`` per operator, on one exchange by entity.

Range frames with ``max`` assume one row per (entity, period); cells from
``cell_stats`` have that by construction.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.features import pct_change

PERIOD = "_period"


def _spec(entity: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*entity).orderBy(F.col(PERIOD))


def _with_period(cells: DataFrame, period: str) -> DataFrame:
    return cells.withColumn(PERIOD, F.col(period).cast("long"))


def growth(cells: DataFrame, entity: str | Sequence[str], *, period: str = "year",
           value: str = "median_price") -> DataFrame:
    """Add ``prev_median`` (value of the previous *period*, NULL over a gap),
    ``yoy_pct``, ``first_median`` (the entity's first surviving value) and
    ``cumulative_growth_pct``."""
    entity = [entity] if isinstance(entity, str) else list(entity)
    spec = _spec(entity)
    prev = spec.rangeBetween(-1, -1)
    whole = spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = _with_period(cells, period).withColumns({
        "prev_median": F.max(value).over(prev),
        "first_median": F.first(value).over(whole),
    })
    return out.withColumns({
        "yoy_pct": pct_change(value, "prev_median"),
        "cumulative_growth_pct": pct_change(value, "first_median"),
    }).drop(PERIOD)


def rolling_mean(cells: DataFrame, entity: str | Sequence[str], *, periods: int = 3,
                 period: str = "year", value: str = "median_price",
                 out: str = "rolling_avg_median", digits: int = 0) -> DataFrame:
    """Mean of the last ``periods`` *periods* of ``value`` (a mean of medians,
    hence the name); a gap shrinks the sample instead of stretching the span."""
    if periods < 1:
        raise ValueError("periods must be >= 1")
    entity = [entity] if isinstance(entity, str) else list(entity)
    frame = _spec(entity).rangeBetween(-(periods - 1), 0)
    return (_with_period(cells, period)
            .withColumn(out, F.round(F.avg(value).over(frame), digits))
            .drop(PERIOD))


def latest_growth(cells: DataFrame, entity: str, *, top_n: int = 20, period: str = "year",
                  value: str = "median_price") -> DataFrame:
    """Top ``top_n`` entities by cumulative growth at their own latest period.

    The latest period comes from the same window as the growth columns
    (``max(period)`` over the whole entity partition), so there is no second
    scan and no self-join. NULL entities are dropped (they would not have
    joined). Ties are broken by entity, so the cut is deterministic.
    """
    spec = _spec([entity])
    whole = spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    g = _with_period(cells, period).withColumns({
        "first_median": F.first(value).over(whole),
        "_latest": F.max(PERIOD).over(whole),
    })
    g = g.filter((F.col(PERIOD) == F.col("_latest")) & F.col(entity).isNotNull())
    g = g.withColumn("cumulative_growth_pct", pct_change(value, "first_median"))
    return (g.select(entity, period, value, "cumulative_growth_pct", "transactions")
             .orderBy(F.desc_nulls_last("cumulative_growth_pct"), F.asc(entity))
             .limit(top_n))
