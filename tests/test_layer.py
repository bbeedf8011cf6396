"""Feed CSV contract, partitioned layer, sink, footprint and plan pushdown."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brickyard.functions import apply_rules, enrich
from brickyard.operators.slices import year_slice_counts
from brickyard.plans.inspect import physical_plan
from brickyard.plans.jobs import ingest, ingest_frame
from brickyard.sources.contract import FEED_SCHEMA, read_feed_csv, write_feed_csv
from brickyard.sources.layer import (
    exists, footprint, read_layer, read_summary, scratch_dir, scratch_root, write_layer, write_summary,
)
from brickyard.sources.sales import sales_view

from .conftest import KEPT, frame, made, yearly


class Session:
    """Stands in for a session of some master and checkpoint settings."""

    def __init__(self, master, named=None, held=None):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master, self.held = master, held

    def getCheckpointDir(self):
        return self.held


@pytest.mark.parametrize("session, root", [
    (Session("yarn", "hdfs://n/shared/"), "hdfs://n/shared"), (Session("yarn", None, "hdfs://n/own/id"), "hdfs://n/own/id"),
    (Session("yarn", "/shared", "file:/shared/some-id"), "/shared"), (Session("local[2]", "/shared", "file:/own/id"), "file:/own/id"),
])
def test_scratch_root_follows_the_session(session, root):
    assert scratch_root(session) == root


@pytest.mark.parametrize("master", ["yarn", "spark://host:1", "local-cluster[2,1,512]", "k8s://https://host"])
def test_no_folder_of_one_machine_off_a_local_master(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session(master))


def test_derived_data_follow_their_input(spark, tmp_path):
    from brickyard import catalog
    built = []
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.parquet").write_text("1")
    make = lambda: catalog._once(spark, str(folder), "kind", lambda p: (built.append(p), spark.range(1).write.parquet(p)))
    first = make()
    assert make() == first and len(built) == 1 and exists(spark, first)
    (folder / "a.parquet").write_text("22")
    assert make() != first and len(built) == 2


def test_only_clean_rows_are_laid_out(spark, sample_df):
    rows, _ = ingest_frame(sample_df)
    plan = physical_plan(rows)
    assert 0 <= plan.index("Exchange") < plan.index("Filter") < plan.index("CollectMetrics")


def test_only_the_feeds_columns_cross_the_layout_shuffle(spark, sample_df):
    rows, _ = ingest_frame(sample_df)
    above, below = physical_plan(rows).split("Exchange", 1)
    for name in ("property_type_name", "duration_name", "ppd_category_name", "postcode_area"):
        assert name in above and name not in below
    direct = ingest_frame(sample_df, layout="map")[0]
    assert rows.columns == direct.columns
    assert sorted(map(str, rows.collect())) == sorted(map(str, direct.collect()))


def star(spark, folder):
    """Small star-schema tables: two orders of a customer with a nation, one of a customer without, lines without an order or part."""
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "NORTH")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "ALPHA", 0), (14, "OMEGA", 0), (3, "LOST", 9)]),
        "customer": ("c_custkey long, c_nationkey int, c_mktsegment string",
                     [(1, 0, "CARS"), (2, 14, None), (3, 3, "CARS"), (4, None, "CARS"), (None, 0, "CARS")]),
        "part": ("p_partkey long, p_name string, p_type string", [(5, "green nut", "PROMO X"), (6, None, None), (None, "x", "PROMO X")]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string",
                   [(10, 1, "F", "1-URGENT"), (10, 1, "P", None), (11, 2, None, "5-LOW"), (12, 3, "F", None), (13, 4, "F", None), (None, 1, "F", None)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, "
                     "l_linestatus string, l_shipdate timestamp",
                     [(10, 5, 17, 1, 2500.9, "N", "F", dt.datetime(1996, 5, 4)), (11, 6, None, 2, None, "R", None, None), (12, 5, 1, 1, 1.0, "N", "F", None),
                      (13, 5, 1, 1, 1.0, "N", "F", None), (99, 5, 1, 1, 1.0, "N", "F", None), (10, 99, 1, 3, 1.0, "N", "F", None),
                      (None, 5, 1, 1, 1.0, "N", "F", None), (10, None, 1, 4, 1.0, "N", "F", None)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_sales_are_joined_without_a_sort_of_them(spark, tmp_path):
    df = sales_view(spark, star(spark, tmp_path))
    plan = physical_plan(df)
    assert "SortMergeJoin" not in plan and plan.count("ShuffledHashJoin") == 2
    got = sorted(map(tuple, df.select("transaction_id", "price", "postcode", "property_type", "old_new", "duration", "street", "town_city",
                                      "district", "county", "ppd_category_type", "record_status").collect()), key=str)
    assert got == sorted([
        ("10-1", 2500, "SW9 1AA", "S", "Y", "F", "green nut", "CARS", "ALPHA", "NORTH", "B", "A"),
        ("10-1", 2500, "SW9 1AA", "S", "Y", "F", "green nut", "CARS", "ALPHA", "NORTH", "A", "D"),
        ("11-2", None, None, None, None, None, None, None, "OMEGA", "NORTH", "A", None)], key=str)


def test_scratch_dirs_are_fresh(spark):
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(scratch_root(spark))


def test_feed_csv_round_trip_keeps_values_and_nulls(spark, sample_df):
    tricky = frame(spark, [made(transaction_id='quo"ted, 1', street='A "B", 1', old_new=None)])
    df = sample_df.unionByName(tricky)
    path = scratch_dir(spark, "test-feed")
    write_feed_csv(df, path)
    back = read_feed_csv(spark, path)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in FEED_SCHEMA]
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_malformed_cells_become_null_and_are_counted(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text('"b1","abc","2020-01-01 00:00","SW1 1AA","D","N","F","","","","","","X","Y","A","A"\n'
                 '"b2","100000","bad","SW1 1AA","D","N","F","","","","","","X","Y","A","A"\n')
    df = read_feed_csv(spark, str(p))
    rows = {r["transaction_id"]: r for r in df.collect()}
    assert rows["b1"]["price"] is None and rows["b2"]["date_of_transfer"] is None
    assert apply_rules(df).count() == 0


def test_ingest_observes_audit_and_partitions_by_year(spark, sample_df):
    path = scratch_dir(spark, "test-layer")
    audit = ingest(sample_df, path)
    assert audit["rows_raw"] == sample_df.count() and audit["rows_clean"] == len(KEPT)
    layer = read_layer(spark, path)
    assert layer.count() == len(KEPT)
    assert dict(layer.dtypes)["year"] == "int"
    expected = enrich(apply_rules(sample_df))
    cols = ["transaction_id", "price", "year", "postcode_area", "is_new_build"]
    assert layer.select(cols).exceptAll(expected.select(cols)).count() == 0


def test_partition_pruning_and_range_pushdown(spark, sample_df):
    path = scratch_dir(spark, "test-layer")
    ingest(sample_df, path)
    pruned = physical_plan(year_slice_counts(read_layer(spark, path), 2007, by="property_type",
                                             period="year"))
    assert "PartitionFilters: [isnotnull(year" in pruned and "(year#" in pruned
    raw_path = scratch_dir(spark, "test-raw")
    sample_df.write.parquet(raw_path)
    ranged = physical_plan(year_slice_counts(spark.read.parquet(raw_path), 2007,
                                             by="property_type", ts="date_of_transfer"))
    assert "GreaterThanOrEqual(date_of_transfer" in ranged
    assert "LessThan(date_of_transfer" in ranged


def test_summary_sink_counts_while_writing(spark, sample_df):
    agg = enrich(apply_rules(sample_df)).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_dir(spark, "test-sink")
    assert write_summary(agg, path) == agg.count()
    back = read_summary(spark, path, "year int, n long")
    assert back.exceptAll(agg).count() == 0


def test_footprint_sums_data_files(spark, sample_df):
    path = scratch_dir(spark, "test-fp")
    sample_df.write.parquet(path)
    row = footprint(spark, {"p": path}).first()
    assert row["dataset"] == "p" and row["files"] >= 1 and row["bytes"] > 0


def test_rebalance_layout_writes_one_file_per_year(spark):
    """Rows spread over many partitions: map-only writes a file per (task, year),
    the rebalance layout about one per year (AQE merges small partitions)."""
    import glob

    rows = yearly({y: 30_000 + y for y in range(2012, 2018)}, rows=50)
    df = enrich(apply_rules(frame(spark, rows))).repartition(8)

    def files(layout):
        path = scratch_dir(spark, f"test-{layout}")
        write_layer(df, path, layout=layout)
        return len(glob.glob(path.replace("file:", "") + "/year=*/*.parquet"))

    assert files("rebalance") == 6
    assert files("map") > 6
