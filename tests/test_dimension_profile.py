"""Dimension joins and strategies, hygiene, coverage, skew and headline."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from brickyard.functions import apply_rules, enrich
from brickyard.operators import (
    counts_by_key, coverage, dimension_hygiene, enrich_join, headline, skew_profile, strategy_parity,
)
from brickyard.plans.inspect import physical_plan
from brickyard.sources.regions import REGIONS, region_lookup, region_pairs

from .conftest import frame, made, yearly


@pytest.fixture(scope="module")
def mixed_df(spark):
    rows = yearly({2009: 58_000, 2010: 59_500}, rows=42, postcode="YO7 8AB")
    rows += [made(transaction_id="unknown", price=77_000, postcode="QQ1 2AB"), made(transaction_id="missing", postcode=None),
             made(transaction_id="border", postcode="TD15 1ZZ"), made(transaction_id="north", postcode="CA2 5LM")]
    return enrich(apply_rules(frame(spark, rows)))


def regions_by_id(df):
    return {r["transaction_id"]: r["region"] for r in df.collect()}


def test_maps_area_and_keeps_unmatched_and_null_rows(mixed_df, spark):
    out = regions_by_id(enrich_join(mixed_df, region_lookup(spark), "postcode_area"))
    assert len(out) == mixed_df.count()
    assert out["unknown"] is None and out["missing"] is None
    assert out["north"] == "North West" and out["border"] == "North East"
    assert list(out.values()).count("Yorkshire") == 84


@pytest.mark.parametrize("strategy", ["merge", "auto"])
def test_strategies_return_the_same_rows(mixed_df, spark, strategy):
    dim = region_lookup(spark)
    a = enrich_join(mixed_df, dim, "postcode_area", strategy="broadcast")
    b = enrich_join(mixed_df, dim, "postcode_area", strategy=strategy)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    parity = strategy_parity(a, b, ["region"]).first()
    assert parity["groups_differing"] == 0 and parity["rows_a"] == parity["rows_b"]


def test_parity_detects_a_difference(mixed_df, spark):
    dim = region_lookup(spark)
    a = enrich_join(mixed_df, dim, "postcode_area")
    b = a.filter(F.col("transaction_id") != "north")
    assert strategy_parity(a, b, ["region"]).first()["groups_differing"] == 1


def test_plans_use_the_requested_join(mixed_df, spark):
    dim = region_lookup(spark)
    assert "BroadcastHashJoin" in physical_plan(enrich_join(mixed_df, dim, "postcode_area"))
    merge = physical_plan(enrich_join(mixed_df, dim, "postcode_area", strategy="merge"))
    assert "SortMergeJoin" in merge and "BroadcastHashJoin" not in merge


@pytest.mark.parametrize("hot_share", [None, 0.5, 0.005])
def test_merge_join_of_hot_and_missing_keys(mixed_df, spark, hot_share):
    dim = region_lookup(spark)
    a = enrich_join(mixed_df, dim, "postcode_area")
    b = enrich_join(mixed_df, dim, "postcode_area", strategy="merge", hot_share=hot_share, salts=5)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merge_join_reads_the_columns_that_are_used(mixed_df, spark, tmp_path):
    mixed_df.write.parquet(str(tmp_path / "wide"))
    df = spark.read.parquet(str(tmp_path / "wide"))
    joined = enrich_join(df, region_lookup(spark), "postcode_area", strategy="merge")
    plan = physical_plan(joined.groupBy("region").agg(F.count(F.lit(1)).alias("rows")))
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<postcode_area:string>" in plan


def test_counts_by_key_equal_the_joined_rows(mixed_df, spark, tmp_path):
    dim = region_lookup(spark)
    for by in (["postcode_area"], ["region"], ["region", "year"]):
        want = enrich_join(mixed_df, dim, "postcode_area").groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
        got = counts_by_key(mixed_df, dim, "postcode_area", by)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_broadcast_beyond_the_bound_raises(mixed_df, spark):
    with pytest.raises(ValueError, match="broadcast bound"):
        enrich_join(mixed_df, region_lookup(spark), "postcode_area", max_broadcast_bytes=100)


def test_dimension_hygiene(spark):
    dim = region_lookup(spark)
    row = dimension_hygiene(dim, "postcode_area", "region", allowed=REGIONS).first()
    assert row["dim_rows"] == 121 == row["distinct_keys"]
    assert row["duplicate_keys"] == 0 and row["malformed_keys"] == 0
    assert row["values_outside_set"] == 0
    assert dict(region_pairs())["TD"] == "North East"


def test_coverage_counts(mixed_df, spark):
    row = coverage(enrich_join(mixed_df, region_lookup(spark), "postcode_area"),
                   "postcode_area", "region").first()
    assert row["unmatched_rows"] == 1 and row["null_key_rows"] == 1 and row["unmatched_keys"] == 1
    assert row["matched_rows"] == row["rows"] - 2


def test_skew_shares_are_bounded_and_ordered(mixed_df):
    rows = skew_profile(mixed_df, "postcode_area", 10).collect()
    assert rows[0]["postcode_area"] == "YO"
    assert all(0 < r["pct_of_total"] <= 100 for r in rows)
    assert sum(r["rows"] for r in rows) == mixed_df.count()
    # ties (1 row each) break on key, NULL first
    assert [r["postcode_area"] for r in rows[1:]] == [None, "CA", "QQ", "TD"]


def test_headline_in_one_row(mixed_df):
    row = headline(mixed_df).first()
    assert row["total_rows"] == mixed_df.count()
    assert (row["year_min"], row["year_max"]) == (2007, 2010)
    assert row["districts"] == 1 and row["postcode_areas"] == 4
    assert row["median_price_all_time"] == 59_500  # 42 of 88 rows lie below
