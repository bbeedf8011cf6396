"""Derived columns (calendar parts, prefix keys, code decodes, flags).

All are built-in column expressions, so they stay inside whole-stage codegen
and are constant-folded where possible. ``enrich`` applies the full set in one
``withColumns`` so the plan holds one ``Project``.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .codes import DURATIONS, PPD_CATEGORIES, PROPERTY_TYPES


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(c: str | Column, table: Mapping[str, str]) -> Column:
    """Look a code up in a literal map; unknown or NULL codes give NULL."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.create_map(*pairs)[_col(c)]


def alpha_prefix(c: str | Column, max_letters: int = 2) -> Column:
    """Leading 1..``max_letters`` letters, upper-cased; NULL when there are none.

    ``"SW1A 1AA"`` → ``"SW"``; NULL or a value starting with a non-letter → NULL,
    so rows without a key form the NULL group instead of an empty-string one.
    """
    pattern = rf"^([A-Za-z]{{1,{max_letters}}})"
    raw = F.upper(F.regexp_extract(F.coalesce(_col(c), F.lit("")), pattern, 1))
    return F.when(raw == "", F.lit(None).cast("string")).otherwise(raw)


def flag(c: str | Column, true_code: str = "Y", false_code: str | None = None) -> Column:
    """Three-valued flag.

    Lenient (``false_code`` None): NULL stays NULL, ``true_code`` is true and any
    other code is false. Strict: ``true_code`` true, ``false_code`` false,
    anything else (including stray codes) NULL.
    """
    x = _col(c)
    if false_code is None:
        return x == F.lit(true_code)
    return (F.when(x == F.lit(true_code), F.lit(True))
             .when(x == F.lit(false_code), F.lit(False)))


def pct_change(new: str | Column, base: str | Column, digits: int = 2) -> Column:
    """``round(100·(new − base) / base, digits)``; NULL when base is 0 or NULL."""
    n, b = _col(new), _col(base)
    return F.round(F.try_divide(F.lit(100.0) * (n - b), b), digits)


def share_pct(part: str | Column, total: str | Column, digits: int = 3) -> Column:
    """``round(100·part / total, digits)``; NULL on a zero total."""
    return F.round(F.try_divide(F.lit(100.0) * _col(part), _col(total)), digits)


def calendar_columns(ts: str = "date_of_transfer") -> dict[str, Column]:
    t = F.col(ts)
    return {
        "transfer_date": F.to_date(t),
        "year": F.year(t),
        "month": F.month(t),
        "quarter": F.quarter(t),
    }


def enrich(df: DataFrame, *, strict_flag: bool = False) -> DataFrame:
    """Add every derived column of the transaction contract in one projection.

    ``is_new_build`` is lenient by default (NULL stays NULL, stray codes are
    existing stock); ``strict_flag=True`` turns stray codes into NULL as well.
    ``ppd_category_name`` decodes the category table, which the feed declares.
    """
    cols = calendar_columns("date_of_transfer")
    cols.update({
        "postcode_area": alpha_prefix("postcode"),
        "is_new_build": flag("old_new", "Y", "N" if strict_flag else None),
        "property_type_name": decode("property_type", PROPERTY_TYPES),
        "duration_name": decode("duration", DURATIONS),
        "ppd_category_name": decode("ppd_category_type", PPD_CATEGORIES),
    })
    return df.withColumns(cols)
