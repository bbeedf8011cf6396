"""The stored cube against the direct operators, and mergeable sketches against exact values."""
from __future__ import annotations

import datetime as dt
import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from brickyard.functions import apply_rules, enrich
from brickyard.operators import cell_stats, enrich_join, headline, premium, skew_profile
from brickyard.operators.cube import SETS, build_cube, grouping_mark, read_cube, write_counts
from brickyard.operators.sketches import (
    DISTINCT_ERROR, RANK_ERROR, merged_distinct, merged_quantiles, rank_errors, sketch_distinct, sketch_quantiles,
)
from brickyard.plans import jobs
from brickyard.plans.inspect import physical_plan
from brickyard.sources.layer import read_layer
from brickyard.sources.regions import region_lookup

from .conftest import frame, made


def market(seed: int = 3, rows: int = 900):
    rng = random.Random(seed)
    return [made(transaction_id=str(k), price=rng.choice([1000, 2500, rng.randint(1000, 90000)]),
                 date_of_transfer=dt.datetime(rng.choice([1999, 2000, 2001]), rng.randint(1, 12), 3),
                 postcode=rng.choice(["OX4 2PQ", "B1 1AA", "ZZ9 9ZZ", None]), property_type=rng.choice("DST?"),
                 old_new=rng.choice(["Y", "N", None]), district=rng.choice(["Vale", "Hill", None, "Thin" if k % 97 == 0 else "Vale"]))
            for k in range(rows)]


@pytest.fixture(scope="module")
def rows(spark):
    return enrich(apply_rules(frame(spark, market()))).cache()


@pytest.fixture(scope="module")
def cube(spark, rows, tmp_path_factory):
    return build_cube(rows, str(tmp_path_factory.mktemp("cube")), dim=region_lookup(spark))


def bag(df, *drop):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(SETS))
@pytest.mark.parametrize("floor", [None, 30])
def test_cells_equal_the_direct_operator(spark, rows, cube, name, floor):
    base = enrich_join(rows, region_lookup(spark), "postcode_area") if name == "region" else rows
    want = cell_stats(base, SETS[name], min_rows=floor)
    assert bag(cube.cells(name, min_rows=floor, with_mean=True)) == bag(want)


@pytest.mark.parametrize("percent", [1, 25, 99, 100])
def test_any_stored_percentile_is_exact(rows, cube, percent):
    want = rows.groupBy("district", "year").agg(
        F.expr(f"percentile_disc({percent / 100}) WITHIN GROUP (ORDER BY price)").alias("v"), F.count(F.lit(1)).alias("n"))
    assert bag(cube.cells("district", percent=percent)) == bag(want)
    with pytest.raises(ValueError):
        cube.cells("district", percent=0)


def test_a_group_stores_at_most_a_hundred_rows(cube):
    sizes = cube.percentiles.groupBy("key_set", *{k for keys in SETS.values() for k in keys}).count()
    assert sizes.agg(F.max("count")).first()[0] <= 100 and cube.counts.agg(F.sum("n")).first()[0] > 800


def test_headline_and_skew_equal_the_direct_operators(rows, cube):
    assert bag(cube.headline()) == bag(headline(rows))
    assert [tuple(r) for r in cube.skew(top_n=3).collect()] == [tuple(r) for r in skew_profile(rows, top_n=3).collect()]


def test_premium_from_cohort_cells(rows, cube):
    got = jobs.summary_from_cube(cube, "new_build_premium")
    assert bag(got) == bag(premium(rows, ["year", "property_type_name"], "is_new_build"))


@pytest.mark.parametrize("name", jobs.SUMMARY_NAMES)
def test_every_summary_follows_from_the_cube(rows, cube, name):
    assert bag(jobs.summary_from_cube(cube, name, since_year=2000)) == bag(jobs.summary(rows, name, since_year=2000))


def test_cells_need_no_exchange_and_prune_key_sets(cube):
    plan = physical_plan(cube.cells("district", min_rows=30))
    assert "Exchange" not in plan and "Window" not in plan and "PartitionFilters: [isnotnull(key_set" in plan
    assert "GreaterThanOrEqual(rows,30)" in plan


def test_the_layer_is_read_once_for_all_summaries(spark, rows, tmp_path):
    rows.write.partitionBy("year").parquet(f"{tmp_path}/layer")
    layer = read_layer(spark, f"{tmp_path}/layer")
    written = jobs.analyse(layer, f"{tmp_path}/out")
    assert set(written) == set(jobs.SUMMARY_NAMES) and all(written.values())
    cube = read_cube(spark, f"{tmp_path}/out/_cube")
    frames = [jobs.summary_from_cube(cube, n) for n in jobs.SUMMARY_NAMES] + [cube.headline(), cube.skew()]
    assert not any(f"{tmp_path}/layer" in f for x in frames for f in x.inputFiles())
    from brickyard.operators.cube import counts
    plan = physical_plan(counts(layer))
    assert plan.count("FileScan") == 1 and "transaction_id" not in plan
    # with the layer gone, all outputs can still be made: nothing reads it a second time
    spark._jvm.org.apache.hadoop.fs.Path(f"{tmp_path}/layer").getFileSystem(spark._jsc.hadoopConfiguration()).delete(
        spark._jvm.org.apache.hadoop.fs.Path(f"{tmp_path}/layer"), True)
    assert all(x.count() for x in frames)


def test_one_year_is_counted_again(spark, rows, tmp_path):
    path = f"{tmp_path}/cube"
    before = build_cube(rows, path, dim=region_lookup(spark)).cells("year").collect()
    more = rows.unionByName(rows.where("year = 2000").withColumn("price", F.lit(77)))
    after = build_cube(more.where("year = 2000"), path, dim=region_lookup(spark), years=[2000])
    got = {r["year"]: r for r in after.cells("year").collect()}
    for r in before:
        assert got[r["year"]]["transactions"] == r["transactions"] * (2 if r["year"] == 2000 else 1)
    assert bag(after.cells("year", with_mean=True)) == bag(cell_stats(more, ["year"]))


def test_missing_values_and_no_rows(spark, tmp_path):
    schema = "district string, postcode_area string, property_type_name string, is_new_build boolean, year int, quarter int, price int"
    data = [("a", None, None, None, 2000, 1, None), ("a", None, None, None, 2000, 1, None), ("b", None, None, True, 2000, 1, 5),
            ("b", None, None, True, 2000, 1, None), (None, None, None, False, 2001, 1, 7)]
    df = spark.createDataFrame(data, schema)
    sets = {"district": ("district", "year"), "all": ()}
    got = build_cube(df, f"{tmp_path}/a", sets=sets)
    for name, keys in sets.items():
        assert bag(got.cells(name, with_mean=True)) == bag(cell_stats(df, keys))
    write_counts(df.where("year = 1"), f"{tmp_path}/none")
    with pytest.raises(ValueError):
        build_cube(df, f"{tmp_path}/b", sets={"x": ("year",), "y": ("year",)})


def test_grouping_marks():
    assert grouping_mark(["a", "b", "c"], ["a", "b", "c"]) == 0 and grouping_mark(["a", "b", "c"], ["b"]) == 0b101


# --- sketches

def test_merged_sketches_hold_the_rank_bound(spark):
    df = spark.range(60000).select((F.col("id") % 7).alias("k"), (F.col("id") % 5).alias("year"),
                                   (F.pmod(F.xxhash64("id"), F.lit(10**6))).cast("int").alias("price"))
    stored = sketch_quantiles(df, ["k"])
    for keys in (["k"], ["k", "year"], []):
        for percent in (10, 50, 90):
            est = merged_quantiles(stored, keys, percent=percent, name="v")
            errors = rank_errors(est, df, keys, "price", percent=percent, name="v").collect()
            assert len(errors) == max(1, reduce(lambda a, c: a * (7 if c == "k" else 5), keys, 1))
            assert sum(r["rows"] for r in errors) == 60000 and all(r["error"] <= RANK_ERROR for r in errors)


def test_sketches_of_missing_values(spark):
    df = spark.createDataFrame([("a", 1, None, None), ("b", 1, 4, "x"), ("b", 2, None, "x"), (None, 2, 9, "y")], "k string, year int, price int, d string")
    got = {r["k"]: (r["median_price"], r["rows"]) for r in merged_quantiles(sketch_quantiles(df, ["k"]), ["k"]).collect()}
    assert got == {"a": (None, 0), "b": (4, 1), None: (9, 1)}
    assert merged_distinct(sketch_distinct(df, ["k", "d"]), ["k", "d"]).first().asDict() == {"k": 2, "d": 2}
    assert merged_distinct(sketch_distinct(df.limit(0), ["k"]), ["k"]).first()["k"] == 0


def test_merged_distinct_counts_hold_their_bound(spark):
    df = spark.range(100000).select((F.col("id") % 9).alias("year"), (F.col("id") % 31000).alias("d"), (F.col("id") % 40).alias("few"))
    stored = sketch_distinct(df, ["d", "few"])
    got = merged_distinct(stored, ["d", "few"]).first()
    assert abs(got["d"] - 31000) <= DISTINCT_ERROR * 31000 and got["few"] == 40
    assert "Expand" not in physical_plan(stored)
