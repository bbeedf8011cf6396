"""Enrichment joins to a dimension, with an explicit join strategy.

``strategy``:

- ``"broadcast"`` — broadcast hash join behind a check of the dimension's size in bytes,
  measured on its values (``size_in_bytes``). A dimension beyond ``max_broadcast_bytes`` raises, so the plan never
  changes without notice: ask for ``"merge"`` or ``"auto"`` then.
- ``"merge"`` — sort-merge join, by hint (no session setting is changed), on the
  columns the query needs: nothing hashes the row. Rows with a NULL key can't match;
  their shuffle key is spread over ``NULL_SPREAD`` values in the same pass, so they
  never pile into the one partition that NULL hashes to. A skewed key is split by
  AQE. ``hot_share`` additionally salts the keys that hold more than that share of
  the fact's rows (measured on the key column alone; at most ``1 / hot_share`` keys,
  which bounds what the driver holds): only their dimension rows are copied, ``salts``
  times. A count by key needs no join of rows at all: see ``counts_by_key``.
- ``"auto"`` — no hint: Catalyst / AQE decide from size statistics.

All strategies return the same rows (see ``strategy_parity``).
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from ..functions.features import share_pct

MAX_BROADCAST_BYTES = 64 << 20
NULL_SPREAD = 64


def size_in_bytes(df: DataFrame) -> int:
    """Bytes of the rows as a hash table holds them, measured by one aggregate: for every column a slot of
    8 bytes, for text and binary values their own bytes, for nested values those of their JSON text."""
    sizes = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            sizes.append(F.octet_length(c))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            sizes.append(F.octet_length(F.to_json(F.struct(c))))
    own = reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0)).cast("long") for x in sizes], F.lit(8 * (len(df.columns) + 1)).cast("long"))
    return df.agg(F.sum(own)).first()[0] or 0


def broadcast_checked(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint behind a check of the size; raises beyond it."""
    size = size_in_bytes(df)
    if size > max_bytes:
        raise ValueError(f"a dimension of {size} bytes is beyond the broadcast bound of "
                         f"{max_bytes}; use strategy='merge' or 'auto'")
    return F.broadcast(df)


def hot_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame | None:
    """Keys that hold more than ``share`` of the rows: at most ``1 / share`` of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_t")).scalar()
    return counts.where(F.col("_n") > F.lit(share) * total).select(*keys).dropna()


def enrich_join(df: DataFrame, dim: DataFrame, keys: str | list[str], *,
                strategy: str = "broadcast", max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                hot_share: float | None = None, salts: int = 16) -> DataFrame:
    """Left-outer equi-join of ``df`` to ``dim`` on ``keys``; every input row is
    kept, unmatched and NULL keys get NULL dimension columns."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if strategy == "broadcast":
        return df.join(broadcast_checked(dim, max_broadcast_bytes), on=keys, how="left")
    if strategy == "auto":
        return df.join(dim, on=keys, how="left")
    if strategy != "merge":
        raise ValueError(f"unknown join strategy {strategy!r}")
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    # a row's place in its task spreads what can't match or is salted; results don't depend on it
    place = F.monotonically_increasing_id()
    spread = F.when(missing, 1 + F.pmod(place, F.lit(NULL_SPREAD))).otherwise(F.lit(0)).cast("long")
    if hot_share is not None:
        hot = F.broadcast(hot_keys(df, keys, hot_share).withColumn("_hot", F.lit(True)))   # 1 / hot_share keys
        df = df.join(hot, on=keys, how="left")
        spread = F.when(F.col("_hot"), F.pmod(place, F.lit(salts))).otherwise(spread)
        copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        dim = dim.join(hot, on=keys, how="left").withColumn("_spread", F.explode(copies)).withColumn(
            "_spread", F.col("_spread").cast("long")).drop("_hot")
    else:
        dim = dim.withColumn("_spread", F.lit(0).cast("long"))
    fact = df.withColumn("_spread", spread).drop("_hot")
    return fact.join(dim.hint("merge"), on=[*keys, "_spread"], how="left").drop("_spread")


def counts_by_key(df: DataFrame, dim: DataFrame, keys: str | list[str], by: list[str], *,
                  strategy: str = "merge") -> DataFrame:
    """Rows per ``by`` (columns of either side) after the left join, joining counts per
    key instead of rows: the fact is read in its key columns only and combined before
    the shuffle, so no key is hot."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    own = [c for c in by if c not in dim.columns or c in keys]
    counts = df.groupBy(*dict.fromkeys([*keys, *own])).agg(F.count(F.lit(1)).alias("_n"))
    return enrich_join(counts, dim, keys, strategy=strategy).groupBy(*by).agg(F.sum("_n").alias("rows"))


def coverage(joined: DataFrame, key: str, attr: str) -> DataFrame:
    """One row describing how well a left enrichment matched.

    ``rows``, ``matched_rows``, ``unmatched_rows`` (key present, no match),
    ``null_key_rows``, ``unmatched_keys`` (distinct keys without a match) and
    ``matched_pct``.
    """
    k, a = F.col(key), F.col(attr)
    out = joined.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(a.isNotNull()).alias("matched_rows"),
        F.count_if(k.isNotNull() & a.isNull()).alias("unmatched_rows"),
        F.count_if(k.isNull()).alias("null_key_rows"),
        F.count_distinct(F.when(a.isNull(), k)).alias("unmatched_keys"),
    )
    return out.withColumn("matched_pct", share_pct("matched_rows", "rows", 3))


def fingerprint(df: DataFrame, by: list[str]) -> DataFrame:
    """Order-independent multiset fingerprint of ``df`` per ``by`` group:
    row count plus the sums of two 64-bit row hashes of different seeds (as exact decimals)."""
    cols = [F.col(c) for c in df.columns]
    h1 = F.xxhash64(*cols).cast("decimal(38,0)")
    h2 = F.xxhash64(F.lit(1), *cols).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                               F.sum(h1).alias("h1"), F.sum(h2).alias("h2"))


def strategy_parity(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """Compare two row sets that must be equal (e.g. two join strategies).

    Each side is reduced to a per-group fingerprint (partial aggregation, no
    row shuffle), then the small group tables are compared with a null-safe
    full join. One row: ``rows_a``, ``rows_b``, ``groups``, ``groups_differing``.
    """
    fa = fingerprint(a, by).withColumnsRenamed({"rows": "ra", "h1": "a1", "h2": "a2"})
    fb = fingerprint(b, by).withColumnsRenamed({"rows": "rb", "h1": "b1", "h2": "b2"})
    cond = reduce(lambda x, y: x & y, (fa[c].eqNullSafe(fb[c]) for c in by))
    j = fa.join(fb, cond, "full_outer")
    same = (F.col("ra").eqNullSafe(F.col("rb")) & F.col("a1").eqNullSafe(F.col("b1"))
            & F.col("a2").eqNullSafe(F.col("b2")))
    return j.agg(
        F.coalesce(F.sum("ra"), F.lit(0)).cast("long").alias("rows_a"),
        F.coalesce(F.sum("rb"), F.lit(0)).cast("long").alias("rows_b"),
        F.count(F.lit(1)).alias("groups"),
        F.count_if(~same).alias("groups_differing"),
    )


def dimension_hygiene(dim: DataFrame, key: str, attr: str, *,
                      allowed: tuple[str, ...], key_pattern: str = "^[A-Z]{1,2}$") -> DataFrame:
    """One row of dimension checks: ``dim_rows``, ``distinct_keys``,
    ``duplicate_keys`` (keys on more than one row), ``malformed_keys`` and
    ``values_outside_set``."""
    per_key = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    dups = per_key.agg(F.count_if(F.col("_n") > 1).alias("duplicate_keys"))
    checks = dim.agg(
        F.count(F.lit(1)).alias("dim_rows"),
        F.count_distinct(key).alias("distinct_keys"),
        F.count_if(~F.coalesce(F.col(key).rlike(key_pattern), F.lit(False))).alias("malformed_keys"),
        F.count_if(~F.coalesce(F.col(attr).isin(*allowed), F.lit(False))).alias("values_outside_set"),
    )
    return checks.withColumn("duplicate_keys", dups.scalar())
