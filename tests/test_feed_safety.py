"""Quarantine, staged ingest, single years, bucketed and skewed joins, pruning by a table, isolated sessions."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brickyard.operators import enrich_join, strategy_parity
from brickyard.operators.dimension import broadcast_checked, size_in_bytes
from brickyard.operators.slices import period_slice
from brickyard.plans import jobs
from brickyard.plans.inspect import isolated, physical_plan
from brickyard.sources import layer as layers
from brickyard.sources.bucketed import join_bucketed, write_bucketed
from brickyard.sources.layer import footprint, footprint_by, read_layer, replace_years
from brickyard.sources.quarantine import counts_by_cause, read_feed_marked, split, stage

from .conftest import frame, made, yearly


def line(**fields):
    cells = {"price": "84500", "date_of_transfer": "2007-11-23 00:00"} | fields
    return ",".join(f'"{cells.get(c, "x")}"' for c in frame_columns)


frame_columns = ["transaction_id", "price", "date_of_transfer", "postcode", "property_type", "old_new", "duration", "paon", "saon",
                 "street", "locality", "town_city", "district", "county", "ppd_category_type", "record_status"]


def test_malformed_cells_are_told_apart_from_missing_ones(spark, tmp_path):
    lines = [line(transaction_id="ok"), line(transaction_id="gap", price=""), line(transaction_id="gap2", date_of_transfer=""),
             line(transaction_id="p", price="n/a"), line(transaction_id="big", price="99999999999"), line(transaction_id="d", date_of_transfer="23.11.2007"),
             line(transaction_id="both", price="1,5", date_of_transfer="x"), line(transaction_id="short").rsplit(",", 1)[0],
             line(transaction_id="long") + ',"more"', line(transaction_id="last", record_status="")]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_path}/feed")
    staged = stage(read_feed_marked(spark, f"{tmp_path}/feed"), f"{tmp_path}/staged")
    sound, bad = split(staged)
    assert sorted(r["transaction_id"] for r in sound.collect()) == ["gap", "gap2", "last", "ok"]
    assert sorted((r["line"].split('"')[1], tuple(r["causes"])) for r in bad.collect()) == sorted([
        ("p", ("price",)), ("big", ("price",)), ("d", ("date_of_transfer",)), ("both", ("price", "date_of_transfer")),
        ("short", ("columns",)), ("long", ("columns",))])
    assert {r["cause"]: r["rows"] for r in counts_by_cause(staged).collect()} == {
        "price": 3, "date_of_transfer": 2, "columns": 2, "missing price": 1, "missing date_of_transfer": 1}


def test_a_failing_ingest_leaves_the_old_layer(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/layer"
    jobs.ingest(frame(spark, yearly({2000: 5000, 2001: 6000})), path)
    before = sorted(r["transaction_id"] for r in read_layer(spark, path).collect())
    broken = frame(spark, yearly({1999: 4000})).withColumn("district", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        jobs.ingest(broken, path)
    real = jobs.write_layer
    monkeypatch.setattr(jobs, "write_layer", lambda df, place, **how: (real(df, place, **how), real(df.limit(3), place, **how)))
    with pytest.raises(RuntimeError, match="were written"):
        jobs.ingest(frame(spark, yearly({1999: 4000})), path)
    monkeypatch.undo()
    assert sorted(r["transaction_id"] for r in read_layer(spark, path).collect()) == before
    assert [p.name for p in tmp_path.iterdir()] == ["layer"]                      # no staging folder stays
    jobs.ingest(frame(spark, yearly({1999: 4000})), path)
    assert {r["year"] for r in read_layer(spark, path).collect()} == {1999} and [p.name for p in tmp_path.iterdir()] == ["layer"]


def test_a_failed_publish_brings_the_old_folder_back(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/old")
    with pytest.raises(Exception):
        layers.publish(spark, f"{tmp_path}/nowhere", f"{tmp_path}/old")
    assert spark.read.parquet(f"{tmp_path}/old").count() == 3


def test_single_years_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/layer"
    jobs.ingest(frame(spark, yearly({1999: 4000, 2000: 5000, 2001: 6000})), path)
    stored = jobs.ingest_years(frame(spark, yearly({2000: 9000, 1998: 1}, rows=50)), path, [2000])
    got = {r["year"]: (r["n"], r["p"]) for r in read_layer(spark, path).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.max("price").alias("p")).collect()}
    assert stored == 50 and got == {1999: (36, 4000), 2000: (50, 9000), 2001: (36, 6000)}
    with pytest.raises(ValueError, match="outside"):
        replace_years(read_layer(spark, path), path, [2000])


def test_bytes_by_year_sum_to_the_footprint(spark, tmp_path):
    path = f"{tmp_path}/layer"
    jobs.ingest(frame(spark, yearly({1999: 4000, 2000: 5000})), path)
    by_year = {r["year"]: r for r in footprint_by(read_layer(spark, path)).collect()}
    assert set(by_year) == {1999, 2000} and all(r["rows"] == 36 and r["files"] >= 1 for r in by_year.values())
    whole = footprint(spark, {"x": path}).first()
    assert (sum(r["bytes"] for r in by_year.values()), sum(r["files"] for r in by_year.values())) == (whole["bytes"], whole["files"])


def skewed(spark):
    return spark.range(4000).select(F.col("id"), F.when(F.col("id") % 10 < 7, "HOT").when(F.col("id") % 10 == 7, F.lit(None))
                                    .otherwise(F.concat(F.lit("K"), F.col("id") % 23)).alias("area"))


def dim(spark):
    return spark.createDataFrame([("HOT", "h"), *[(f"K{k}", f"r{k % 4}") for k in range(20)], ("NONE", "z")], "area string, region string")


def test_bucketed_join_shuffles_no_fact_rows(spark, tmp_path):
    df = skewed(spark)
    layer = write_bucketed(df, f"{tmp_path}/b", "area", buckets=4)
    joined = join_bucketed(spark, layer, dim(spark), f"{tmp_path}/d")
    plan = physical_plan(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = df.join(dim(spark), "area", "left").select(*joined.columns)
    out = strategy_parity(joined, want, ["region"]).first()
    assert out["rows_a"] == out["rows_b"] == 4000 and out["groups_differing"] == 0


def test_buckets_grow_with_the_rows(spark, tmp_path):
    df = skewed(spark)
    layer = write_bucketed(df, f"{tmp_path}/b", "area", buckets=4, bucket_rows=400)
    assert layer.buckets == 9                        # 3,600 rows have a key
    joined = join_bucketed(spark, layer, dim(spark), f"{tmp_path}/d")
    plan = physical_plan(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = df.join(dim(spark), "area", "left").select(*joined.columns)
    out = strategy_parity(joined, want, ["region"]).first()
    assert out["rows_a"] == out["rows_b"] == 4000 and out["groups_differing"] == 0


def test_salts_bound_the_largest_task_of_a_hot_area(spark):
    own = isolated(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    df, small = skewed(own), dim(own)

    def largest(joined):
        return max(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())

    plain, salted = enrich_join(df, small, "area", strategy="merge"), enrich_join(df, small, "area", strategy="merge", hot_share=0.2)
    assert largest(plain) >= 2800 and largest(salted) <= 1400
    out = strategy_parity(plain, salted.select(*plain.columns), ["region"]).first()
    assert out["rows_a"] == 4000 and out["groups_differing"] == 0


def test_aqe_splits_the_hot_partition(spark):
    own = isolated(spark, {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
                           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "8",
                           "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"})
    joined = enrich_join(skewed(own).repartition(8), dim(own), "area", strategy="merge")
    assert joined.count() == 4000
    joined.collect()
    assert "SortMergeJoin(skew=true)" in physical_plan(joined)


def test_years_of_a_table_prune_partitions(spark, tmp_path):
    path = f"{tmp_path}/layer"
    jobs.ingest(frame(spark, yearly({1998: 3000, 1999: 4000, 2000: 5000})), path)
    spark.createDataFrame([(1998, 5), (1999, 50), (2001, 60), (None, 99)], "year int, n int").write.parquet(f"{tmp_path}/years")
    out = period_slice(read_layer(spark, path), table=spark.read.parquet(f"{tmp_path}/years").where("n > 10"))
    assert "dynamicpruning" in physical_plan(out).lower()
    assert {r["year"] for r in out.collect()} == {1999} and out.count() == 36


def test_isolated_settings_stay_in_their_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    own = isolated(spark, {"spark.sql.shuffle.partitions": "3"})
    assert own.conf.get("spark.sql.shuffle.partitions") == "3" and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_size_check_measures_values(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("é"), 5000).alias("s"), F.array(F.lit("abc")).alias("a"))
    assert size_in_bytes(wide) >= 100 * 10000
    with pytest.raises(ValueError, match="beyond the broadcast bound"):
        broadcast_checked(wide, 500_000)
    assert size_in_bytes(spark.range(0)) == 0 and size_in_bytes(spark.createDataFrame([(None, 1)], "s string, `a.b` int")) < 100


def test_feed_rows_with_dates_of_another_century(spark, tmp_path):
    df = frame(spark, [made(date_of_transfer=dt.datetime(1899, 12, 31)), made(transaction_id="b")])
    jobs.ingest(df, f"{tmp_path}/l")
    assert sorted(r["year"] for r in read_layer(spark, f"{tmp_path}/l").collect()) == [1899, 2007]
