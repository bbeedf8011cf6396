"""The task-level entry points give the known answers on the edge fixtures."""
from __future__ import annotations

import pytest

from brickyard import api

from .conftest import DROPPED, KEPT, frame, yearly

PRICES = {2005: 48_000, 2006: 51_000, 2007: 66_300}


@pytest.fixture(scope="module")
def path_df(spark):
    return api.enrich(api.clean(frame(spark, yearly(PRICES))))


def test_quality_report(sample_df):
    raw, dropped = len(KEPT | DROPPED), len(DROPPED)
    want = {"rows_raw": raw, "rows_clean": raw - dropped, "rows_dropped": dropped, "pct_dropped": round(100 * dropped / raw, 4)}
    assert api.quality_report(sample_df) == want == api.quality_report(sample_df, api.clean(sample_df))


def test_quality_report_counts_what_was_cleaned_by_other_rules(sample_df):
    strict = api.clean(sample_df).where("price < 1000000 AND postcode IS NOT NULL")
    got = api.quality_report(sample_df, strict)
    assert got["rows_clean"] == strict.count() < len(KEPT) and got["rows_dropped"] == len(KEPT | DROPPED) - strict.count()


@pytest.mark.parametrize("exact", [False, True])
def test_summaries_keep_names_and_values(path_df, exact):
    med = {r["year"]: r["median_price"] for r in api.median_price_by_district_year(path_df, exact=exact).collect()}
    assert med == PRICES
    g = {r["year"]: r for r in api.price_growth_by_district(path_df, exact=exact).collect()}
    assert g[2007]["yoy_pct"] == 30.0 and g[2007]["cumulative_growth_pct"] == pytest.approx(38.13, abs=0.01)
    roll = {r["year"]: r["rolling_avg_median"] for r in api.rolling_median_by_area(path_df, 2, exact=exact).collect()}
    assert roll == {2005: 48_000, 2006: 49_500, 2007: 58_650}
    vol = api.transaction_volume_by_quarter(path_df, exact=exact).collect()
    assert [(r["year"], r["quarter"], r["transactions"]) for r in vol] == [(y, q, 9) for y in PRICES for q in (1, 2, 3, 4)]
    top = api.fastest_growing_districts(path_df, since_year=2006, top_n=5, exact=exact).collect()
    assert [(r["district"], r["cumulative_growth_pct"]) for r in top] == [("Vale", 30.0)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_regions_and_skew(spark, path_df, broadcast):
    joined = api.join_regions(path_df, api.region_lookup(spark), broadcast=broadcast)
    summary = api.region_summary(joined).collect()
    assert [(r["region"], r["year"]) for r in summary] == [("South East", y) for y in PRICES]
    skew = api.skew_profile(path_df).collect()
    assert [(r["postcode_area"], r["pct_of_total"]) for r in skew] == [("OX", 100.0)]


def test_layer_round_trip(spark, sample_df):
    from brickyard.sources.contract import write_feed_csv
    from brickyard.sources.layer import scratch_dir
    csv, pq = scratch_dir(spark, "api-csv"), scratch_dir(spark, "api-pq")
    write_feed_csv(sample_df, csv)
    report = api.build_parquet_layer(spark, csv, pq)
    assert report["rows_raw"] == len(KEPT | DROPPED) and report["rows_clean"] == len(KEPT) and "write_seconds" in report
    assert api.read_parquet(spark, pq).count() == len(KEPT)
    assert api.directory_size_bytes(spark, pq) > 0
    assert api.read_raw_csv(spark, csv, infer=True, sampling_ratio=0.5).count() == len(KEPT | DROPPED)
