"""Median cells: exact definition, floor, NULL handling, approximate path."""
from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brickyard.functions import apply_rules, enrich
from brickyard.operators import cell_stats, median_by
from brickyard.operators.cells import value_bucket

from .conftest import frame, yearly


def lower_median(values):
    vals = sorted(v for v in values if v is not None)
    return vals[math.ceil(len(vals) / 2) - 1] if vals else None


def test_cells_have_each_years_price_and_rows(spark):
    prices = {1999: 71_250, 2001: 64_100, 2006: 133_333}
    df = enrich(apply_rules(frame(spark, yearly(prices, rows=31))))
    out = {r["year"]: r for r in cell_stats(df, ["district", "year"], min_rows=30).collect()}
    assert {y: r["median_price"] for y, r in out.items()} == prices == {y: r["mean_price"] for y, r in out.items()}
    assert {r["transactions"] for r in out.values()} == {31}


@pytest.mark.parametrize("rows", [29, 30])
def test_the_floor_is_the_least_number_of_rows(spark, rows):
    df = enrich(apply_rules(frame(spark, yearly({2011: 99_000}, rows=rows))))
    assert cell_stats(df, ["district", "year"], min_rows=30).count() == (rows >= 30)


def test_even_count_takes_lower_middle(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4)], "k string, v int")
    row = cell_stats(df, ["k"], "v").first()
    assert row["median_v"] == 2 and row["mean_v"] == 2  # mean 2.5 truncates


def test_null_measure_counts_as_row_not_value(spark):
    df = spark.createDataFrame([("a", 5), ("a", None), ("a", 7), ("b", None)], "k string, v int")
    out = {r["k"]: r for r in cell_stats(df, ["k"], "v").collect()}
    assert out["a"]["transactions"] == 3 and out["a"]["median_v"] == 5 and out["a"]["mean_v"] == 6
    assert out["b"]["transactions"] == 1 and out["b"]["median_v"] is None


def test_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 5), (None, 9), ("x", 1)], "k string, v int")
    out = {r["k"]: r["median_v"] for r in median_by(df, ["k"], "v").collect()}
    assert out == {None: 5, "x": 1}


def test_global_median_without_keys(spark):
    df = spark.createDataFrame([(v,) for v in (5, 1, 9, 3)], "v int")
    assert cell_stats(df, [], "v").first()["median_v"] == 3


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(-50, 50))),
                min_size=1, max_size=60))
def test_exact_median_matches_definition(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int")
    for method in ("counts", "two_pass"):
        got = {r["k"]: (r["median_v"], r["transactions"]) for r in cell_stats(df, ["k"], "v", method=method).collect()}
        assert set(got) == {k for k, _ in rows}
        for k in got:
            vals = [v for kk, v in rows if kk == k]
            assert got[k] == (lower_median(vals), len(vals))


@pytest.mark.parametrize("method", ["counts", "two_pass"])
def test_nan_ranks_last_as_in_percentile_disc(spark, method):
    nan = float("nan")
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", nan), ("a", nan), ("b", nan), ("b", 7.5), ("c", None), ("c", nan)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = {r["k"]: repr(r["m"]) for r in df.groupBy("k").agg(
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").alias("m")).collect()}
    assert {r["k"]: repr(r["median_v"]) for r in cell_stats(df, ["k"], "v", method=method).collect()} == want


def test_buckets_keep_the_order_and_part_small_values(spark):
    values = sorted({0.0, 1e-300, 5e-324, -1e-9, -3.5, 1.7e308, -1.7e308, *[k * 1e-8 for k in range(1, 400)]})
    df = spark.createDataFrame([(v,) for v in [*values, float("nan")]], "v double").select("v", value_bucket(F.col("v")).alias("b"))
    got = [r["b"] for r in df.collect()]
    assert got == sorted(got) and len(set(got)) > 300


def test_the_median_is_lazy(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building medians")
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS v")
    cell_stats(df, ["k"], "v"), cell_stats(df, ["k"], "v", method="two_pass")
    assert not tracker.getJobIdsForGroup("lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_approximate_path_equals_exact_on_small_cells(spark):
    rnd = random.Random(7)
    rows = [(f"g{rnd.randrange(5)}", rnd.randrange(1000, 500_000)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int")
    exact = {r["k"]: r["median_v"] for r in cell_stats(df, ["k"], "v").collect()}
    approx = {r["k"]: r["median_v"] for r in cell_stats(df, ["k"], "v", exact=False).collect()}
    assert exact == approx


def test_approximate_path_rank_error_is_bounded(spark):
    """On a large cell the sketch may miss the exact element, within its rank bound."""
    rnd = random.Random(11)
    vals = [rnd.randrange(0, 10_000_000) for _ in range(60_000)]
    df = spark.createDataFrame([("g", v) for v in vals], "k string, v int").repartition(8)
    approx = cell_stats(df, ["k"], "v", exact=False, accuracy=10_000).first()["median_v"]
    rank = sum(1 for v in vals if v <= approx)
    assert abs(rank - len(vals) / 2) <= len(vals) / 10_000 * 2 + 1


def test_hot_group_with_distinct_values_across_sign(spark):
    """One group holds a third of the rows, every value distinct, both signs."""
    rnd = random.Random(3)
    hot = rnd.sample(range(-10**9, 10**9), 20_000)
    rows = [("hot", v) for v in hot]
    rows += [(f"g{i % 50}", rnd.randrange(-10**6, 10**6)) for i in range(40_000)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(8)
    got = {r["k"]: r["median_v"] for r in cell_stats(df, ["k"], "v").collect()}
    by_key: dict[str, list[int]] = {}
    for k, v in rows:
        by_key.setdefault(k, []).append(v)
    assert got == {k: lower_median(vs) for k, vs in by_key.items()}


def test_double_measure_with_fractions(spark):
    rnd = random.Random(5)
    rows = [(f"g{i % 3}", rnd.uniform(-5.0, 5.0)) for i in range(3001)]
    rows += [("g0", 0.0), ("g0", -0.0), ("g1", 1e-300), ("g2", 1e300)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["median_v"] for r in cell_stats(df, ["k"], "v").collect()}
    for k in ("g0", "g1", "g2"):
        assert got[k] == lower_median([v for kk, v in rows if kk == k])


def test_empty_input(spark):
    from brickyard.operators import headline
    df = spark.createDataFrame([], "district string, year int, price int, postcode_area string")
    assert cell_stats(df, ["district", "year"]).count() == 0
    row = headline(df).first()
    assert row["total_rows"] == 0 and row["median_price_all_time"] is None
