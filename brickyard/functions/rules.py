"""Named row rules: one conjunctive filter, and a one-pass audit of what it drops.

A rule is a name and a boolean column. A row passes a rule only when the
predicate is *true*; NULL counts as a failure, exactly as ``filter`` treats it.
``apply`` keeps the predicates bare so Catalyst can push them into the Parquet
scan; ``audit`` wraps them in ``coalesce(…, false)`` to count failures.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .codes import LIVE_STATUSES, MAX_PLAUSIBLE_PRICE, MIN_PLAUSIBLE_PRICE


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column


def price_paid_rules(
    *,
    status: str = "record_status",
    price: str = "price",
    date: str = "date_of_transfer",
    lo: int = MIN_PLAUSIBLE_PRICE,
    hi: int = MAX_PLAUSIBLE_PRICE,
) -> list[Rule]:
    """The feed's cleaning rules: live status, price present and plausible
    (both bounds inclusive), transfer date present."""
    return [
        Rule("live_status", F.col(status).isin(*LIVE_STATUSES)),
        Rule("price_present", F.col(price).isNotNull()),
        Rule("price_plausible", F.col(price).between(lo, hi)),
        Rule("date_present", F.col(date).isNotNull()),
    ]


def _all(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, (r.predicate for r in rules))


def apply_rules(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Keep rows that pass every rule, as one conjunctive filter."""
    rules = list(rules) if rules is not None else price_paid_rules()
    return df.filter(_all(rules))


def audit_columns(rules: Sequence[Rule]) -> list[Column]:
    """Aggregate columns for a one-pass audit (usable in ``agg`` or ``observe``)."""
    passed = F.coalesce(_all(rules), F.lit(False))
    cols = [
        F.count(F.lit(1)).alias("rows_raw"),
        F.count_if(passed).alias("rows_clean"),
    ]
    cols += [F.count_if(~F.coalesce(r.predicate, F.lit(False))).alias(f"failed_{r.name}")
             for r in rules]
    return cols


def audit(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """One row: rows raw, clean, dropped, % dropped (4 dp, 0.0 on empty input)
    and one failure count per rule, all from a single scan."""
    rules = list(rules) if rules is not None else price_paid_rules()
    counts = df.agg(*audit_columns(rules))
    return finish_audit(counts, rules)


def finish_audit(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    dropped = F.col("rows_raw") - F.col("rows_clean")
    pct = F.when(F.col("rows_raw") > 0,
                 F.round(F.lit(100.0) * dropped / F.col("rows_raw"), 4)).otherwise(F.lit(0.0))
    return counts.select(
        "rows_raw", "rows_clean", dropped.alias("rows_dropped"), pct.alias("pct_dropped"),
        *[f"failed_{r.name}" for r in rules],
    )
