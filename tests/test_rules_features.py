"""Cleaning rules, the one-pass audit and derived columns."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from brickyard.functions import alpha_prefix, apply_rules, audit, decode, enrich, flag
from brickyard.functions.codes import PROPERTY_TYPES

from .conftest import DROPPED, KEPT


def ids(df):
    return {r["transaction_id"] for r in df.select("transaction_id").collect()}


def test_clean_keeps_each_edge_of_each_rule(sample_df):
    assert ids(apply_rules(sample_df)) == set(KEPT)


def test_audit_counts_each_rule_in_one_row(sample_df):
    row = audit(sample_df).first().asDict()
    assert (row["rows_raw"], row["rows_clean"], row["rows_dropped"]) == (len(KEPT | DROPPED), len(KEPT), len(DROPPED))
    assert row["pct_dropped"] == round(100 * len(DROPPED) / len(KEPT | DROPPED), 4)
    assert row["failed_live_status"] == 2              # withdrawn, and without a status
    assert row["failed_price_present"] == 1
    assert row["failed_price_plausible"] == 3          # NULL is a failure
    assert row["failed_date_present"] == 1


def test_audit_of_empty_input_reports_zero_percent(spark, sample_df):
    row = audit(sample_df.limit(0)).first()
    assert row["rows_raw"] == 0 and row["pct_dropped"] == 0.0


def test_clean_filters_reach_the_parquet_scan(spark, tmp_path, sample_df):
    path = str(tmp_path / "feed")
    sample_df.write.parquet(path)
    plan = apply_rules(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan
    assert "In(record_status" in plan
    assert "GreaterThanOrEqual(price,1000)" in plan


def test_enrich_derives_every_column(sample_df):
    out = {r["transaction_id"]: r for r in enrich(apply_rules(sample_df)).collect()}
    plain = out["at the floor"]
    assert (plain["postcode_area"], plain["year"], plain["quarter"], plain["month"]) == ("OX", 2007, 4, 11)
    assert plain["transfer_date"] == dt.date(2007, 11, 23)
    assert plain["property_type_name"] == "Semi-Detached" and plain["duration_name"] == "Leasehold"
    assert plain["ppd_category_name"] == "Additional Price Paid" and plain["is_new_build"] is False
    assert out["new"]["is_new_build"] is True and out["no flag"]["is_new_build"] is None
    assert out["no postcode"]["postcode_area"] is None and out["last day of a year"]["quarter"] == 4
    odd = out["odd codes"]
    assert odd["property_type_name"] is odd["duration_name"] is odd["ppd_category_name"] is None


def test_area_edge_cases(spark):
    rows = [("sw1a 1aa",), (" SW1",), ("123",), ("",), (None,), ("W1A",), ("EC1A 1BB",)]
    df = spark.createDataFrame(rows, "postcode string")
    got = [r[0] for r in df.select(alpha_prefix("postcode")).collect()]
    assert got == ["SW", None, None, None, None, "W", "EC"]


def test_flags_lenient_and_strict(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("X",), (None,)], "c string")
    lenient = [r[0] for r in df.select(flag("c")).collect()]
    strict = [r[0] for r in df.select(flag("c", "Y", "N")).collect()]
    assert lenient == [True, False, False, None]
    assert strict == [True, False, None, None]


def test_decode_unknown_and_null_give_null(spark):
    df = spark.createDataFrame([("D",), ("X",), (None,)], "c string")
    assert [r[0] for r in df.select(decode(F.col("c"), PROPERTY_TYPES)).collect()] == \
        ["Detached", None, None]
