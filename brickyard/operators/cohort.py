"""Two-cohort comparison: median of cohort A against cohort B per cell.

Instead of aggregating each cohort separately and joining the two results
(two scans, a join), one pass groups by ``keys`` with the cohort flag as an
extra key, and a second, tiny aggregate over the cell table folds the two
cohort rows of each cell into one. Inner semantics: both cohorts must be
present, NULL keys and a NULL flag belong to neither.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import MEDIAN_ACCURACY
from ..functions.features import pct_change
from .cells import cell_stats


COHORT_NAMES = ("new_build_median", "existing_median", "premium_pct", "new_build_transactions")


def fold_cohorts(per: DataFrame, keys: Sequence[str], flag: str, *, median: str = "_m",
                 names: tuple[str, str, str, str] = COHORT_NAMES) -> DataFrame:
    """``premium`` from cells by (``keys``, ``flag``) with the column ``median`` and ``transactions``."""
    a_med, b_med, prem, a_rows = names
    per = per.filter(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in [*keys, flag]]))
    f = F.col(flag)
    folded = per.groupBy(*keys).agg(
        F.max(F.when(f, F.col(median))).alias(a_med),
        F.max(F.when(~f, F.col(median))).alias(b_med),
        F.coalesce(F.sum(F.when(f, F.col("transactions"))), F.lit(0)).alias(a_rows),
        F.count_if(~f).alias("_b_cells"),
    )
    folded = folded.filter(F.col(a_rows) > 0).filter(F.col("_b_cells") > 0)
    return folded.select(*keys, a_med, b_med, pct_change(a_med, b_med).alias(prem), a_rows)


def premium(df: DataFrame, keys: Sequence[str], flag: str, *, measure: str = "price",
            exact: bool = True, method: str = "counts", accuracy: int = MEDIAN_ACCURACY,
            names: tuple[str, str, str, str] = COHORT_NAMES,
            ) -> DataFrame:
    """Per cell of ``keys``: median of the true cohort, of the false cohort,
    the % premium of true over false, and the true cohort's row count."""
    keys = list(keys)
    a_med, b_med, prem, a_rows = names
    known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys + [flag]])
    base = df.filter(known)
    if exact and method != "approx":
        per = cell_stats(base, keys + [flag], measure, method=method, with_mean=False,
                         median_name="_m")
        return fold_cohorts(per, keys, flag, names=names)
    f = F.col(flag)
    folded = base.groupBy(*keys).agg(
        F.percentile_approx(F.when(f, F.col(measure)), 0.5, accuracy).alias(a_med),
        F.percentile_approx(F.when(~f, F.col(measure)), 0.5, accuracy).alias(b_med),
        F.count_if(f).alias(a_rows),
        F.count_if(~f).alias("_b_cells"),
    ).filter((F.col(a_rows) > 0) & (F.col("_b_cells") > 0))
    return folded.select(*keys, a_med, b_med, pct_change(a_med, b_med).alias(prem), a_rows)
