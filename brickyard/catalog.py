"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per name.

The data flow is the feed's own: the star-schema tables under ``sf_dir`` are
projected onto the feed contract (``sources.sales``), ingested once per
session into a clean, enriched, year-partitioned Parquet layer under the
session's checkpoint folder (``plans.jobs.ingest``), and every analysis runs
one operator over the whole layer. Queries about the raw feed (audit, derived
columns, CSV round trips) read the projection or its CSV form directly. The
SQL oracle for each name is in ``oracle.py`` under the same key.
"""
from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import apply_rules, audit, enrich, flag
from .functions.codes import FEED_COLUMNS, MEDIAN_ACCURACY, MIN_CELL_ROWS
from .operators import (
    cell_stats, counts_by_key, coverage, dimension_hygiene, enrich_join, growth, latest_growth,
    median_by, premium, rolling_mean, skew_profile, strategy_parity,
)
from .operators.cube import Cube, build_cube, read_cube
from .operators.dimension import hot_keys
from .operators.sketches import (
    DISTINCT_ERROR, RANK_ERROR, merged_distinct, merged_quantiles, rank_errors, sketch_distinct, sketch_quantiles,
)
from .operators.slices import period_slice, year_slice_counts
from .plans import jobs
from .plans.inspect import isolated
from .plans.jobs import ingest
from .sources.bucketed import join_bucketed, write_bucketed
from .sources.contract import check_contract, read_feed_csv, read_feed_csv_inferred, write_feed_csv
from .sources.layer import exists, footprint, footprint_by, read_layer, read_summary, scratch_dir, state, write_summary
from .sources.quarantine import counts_by_cause, read_feed_marked, stage
from .sources.regions import REGIONS, region_lookup
from .sources.sales import sales_view

Query = Callable[[SparkSession, str], DataFrame]

LATEST_SINCE = 1997          # the data spans 1995-2001, so the cut does something
LATEST_TOP_N = 20
SKEW_TOP_N = 10
SLICE_YEARS = (1996, 1998, 2000)
SLICE_RECENT = 1999
SLICE_YEAR = 2000
YEAR_SLICE = 1998
JOIN_BUCKETS = 8
HOT_SHARE = 0.045            # of the sales: areas above it are salted

ENRICHED_COLUMNS = [
    "transaction_id", "price", "date_of_transfer", "postcode", "district", "record_status",
    "transfer_date", "year", "month", "quarter", "postcode_area", "is_new_build",
    "is_new_build_strict", "property_type_name", "duration_name", "ppd_category_name",
]


_BUILT: dict[tuple, str] = {}
_LOCK = threading.RLock()           # building one dataset may ask for another


def _once(spark: SparkSession, sf_dir: str, kind: str, build: Callable[[str], object]) -> str:
    """Path of a dataset derived from ``sf_dir``, written once per session and state of
    its input (names, sizes and times of the tables' entries).

    The write goes to a fresh folder under the session's checkpoint folder, so
    lineage is cut there: later queries read the written files, and a lost
    executor costs a task retry, not a rebuild of the star-schema joins.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind, state(spark, sf_dir))
    with _LOCK:
        if key in _BUILT and not exists(spark, _BUILT[key]):
            del _BUILT[key]                  # folder removed under us: rebuild
        if key not in _BUILT:
            path = scratch_dir(spark, kind)
            build(path)
            _BUILT[key] = path
        return _BUILT[key]


def layer_path(spark: SparkSession, sf_dir: str) -> str:
    """The clean, enriched, year-partitioned layer of the sales in ``sf_dir``."""
    return _once(spark, sf_dir, "layer", lambda p: ingest(sales_view(spark, sf_dir), p))


def feed_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """The raw sales of ``sf_dir`` written as a headerless feed CSV."""
    return _once(spark, sf_dir, "feed-csv", lambda p: write_feed_csv(sales_view(spark, sf_dir), p))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, enriched sales — the input of every analysis — read from the
    layer that ``ingest`` wrote (cleaning rules and derived columns applied
    once, at ingest, as the feed's layer is meant to be used)."""
    return read_layer(spark, layer_path(spark, sf_dir))


def cube(spark: SparkSession, sf_dir: str) -> Cube:
    """The stored counts and percentiles of the layer (``operators.cube``), built once with it."""
    path = _once(spark, sf_dir, "cube", lambda p: build_cube(sales(spark, sf_dir), p, dim=region_lookup(spark)))
    return read_cube(spark, path)


def with_regions(df: DataFrame, strategy: str = "broadcast") -> DataFrame:
    return enrich_join(df, region_lookup(df.sparkSession), "postcode_area", strategy=strategy)


# --- cells -----------------------------------------------------------------

def cells_district_year(spark, sf_dir):
    return cube(spark, sf_dir).cells("district", min_rows=MIN_CELL_ROWS, with_mean=True)


def cells_district_type_year(spark, sf_dir):
    return cube(spark, sf_dir).cells("district_type", min_rows=MIN_CELL_ROWS, with_mean=True)


def cells_district_year_approx(spark, sf_dir):
    """A1 with the feed's original sketch median (``percentile_approx``, 10000), held to
    its rank bound: the sketch need not equal the exact element on large cells."""
    df = sales(spark, sf_dir)
    cells = cell_stats(df, ["district", "year"], min_rows=MIN_CELL_ROWS, exact=False)
    return _rank_error(cells, ["district", "year"], df.select("district", "year", "price"))


def cells_quarter(spark, sf_dir):
    return cube(spark, sf_dir).cells("quarter").orderBy("year", "quarter")


def national_year(spark, sf_dir):
    return cube(spark, sf_dir).cells("year").orderBy("year")


def region_year(spark, sf_dir):
    return jobs.summary_from_cube(cube(spark, sf_dir), "region_summary")


# --- trends ----------------------------------------------------------------

def trend_growth_district(spark, sf_dir):
    return growth(cells_district_year(spark, sf_dir), "district")


def trend_growth(spark, sf_dir):
    return growth(cells_district_type_year(spark, sf_dir), ["district", "property_type_name"])


def trend_rolling3(spark, sf_dir):
    return rolling_mean(cube(spark, sf_dir).cells("area"), "postcode_area", periods=3)


def trend_rolling3_gappy(spark, sf_dir):
    cells = cube(spark, sf_dir).cells("district_type", min_rows=MIN_CELL_ROWS)
    return rolling_mean(cells, ["district", "property_type_name"], periods=3)


def latest_growth_top(spark, sf_dir):
    # the base-year cut is on a grouping key: it commutes with the aggregation
    cells = cells_district_year(spark, sf_dir).filter(F.col("year") >= LATEST_SINCE)
    return latest_growth(cells, "district", top_n=LATEST_TOP_N)


# --- cohorts ---------------------------------------------------------------

def cohort_premium(spark, sf_dir):
    return jobs.summary_from_cube(cube(spark, sf_dir), "new_build_premium")


def cohort_premium_approx(spark, sf_dir):
    """C1 with sketch medians, in one aggregate (no join, one exchange). The medians of
    both cohorts are held to the sketch's rank bound, the premium to the two medians and
    the row counts to the cohort; ``beyond_bound`` counts what fails any of these."""
    df = sales(spark, sf_dir)
    keys = ["year", "property_type_name"]
    out = premium(df, keys, "is_new_build", exact=False)
    new, old = (_rank_error(out.select(*keys, F.col(median).alias("median_price")), keys, df.where(cohort).select(*keys, "price"))
                for median, cohort in (("new_build_median", F.col("is_new_build")), ("existing_median", ~F.col("is_new_build"))))
    pct = (F.col("new_build_median") / F.col("existing_median") - 1) * 100
    rest = out.agg(F.count_if(F.coalesce(F.abs(F.col("premium_pct") - pct) > 0.0051, F.lit(True))).alias("wrong"),
                   F.coalesce(F.sum("new_build_transactions"), F.lit(0)).alias("counted"))
    old = old.select(F.col("cells").alias("old_cells"), F.col("beyond_bound").alias("old_beyond"))
    uncounted = (F.coalesce("rows", F.lit(0)) != F.col("counted")).cast("long")
    return new.crossJoin(old).crossJoin(rest).select(
        "cells", "rows", (F.col("beyond_bound") + F.col("old_beyond") + F.abs(F.col("cells") - F.col("old_cells"))
                          + F.col("wrong") + uncounted).alias("beyond_bound"))


# --- dimension joins ---------------------------------------------------------

def region_coverage(spark, sf_dir):
    return coverage(with_regions(sales(spark, sf_dir)), "postcode_area", "region")


def join_strategy_parity(spark, sf_dir):
    df = sales(spark, sf_dir)
    return strategy_parity(with_regions(df, "broadcast"), with_regions(df, "merge"), ["region"])


def dimension_hygiene_q(spark, sf_dir):
    dim = region_lookup(spark)
    checks = dimension_hygiene(dim, "postcode_area", "region", allowed=REGIONS)
    missing = (sales(spark, sf_dir).select("postcode_area").where(F.col("postcode_area").isNotNull())
               .distinct().join(dim, "postcode_area", "left_anti")
               .agg(F.count(F.lit(1)).alias("n")))
    return checks.withColumn("sales_areas_missing", missing.scalar())


def group_counts_region(spark, sf_dir):
    return (with_regions(sales(spark, sf_dir), "broadcast")
            .groupBy("region").agg(F.count(F.lit(1)).alias("rows")))


def group_counts_district_year(spark, sf_dir):
    return sales(spark, sf_dir).groupBy("district", "year").agg(F.count(F.lit(1)).alias("rows"))


def group_counts_area(spark, sf_dir):
    return counts_by_key(sales(spark, sf_dir), region_lookup(spark), "postcode_area", ["postcode_area"])


# --- profiles and audits -----------------------------------------------------

def headline_q(spark, sf_dir):
    return cube(spark, sf_dir).headline()


def skew_top10(spark, sf_dir):
    return skew_profile(sales(spark, sf_dir), "postcode_area", SKEW_TOP_N)


def contract_check(spark, sf_dir):
    return check_contract(sales_view(spark, sf_dir))


def quality_audit(spark, sf_dir):
    return audit(sales_view(spark, sf_dir))


def enriched_rows(spark, sf_dir):
    df = enrich(apply_rules(sales_view(spark, sf_dir)))
    df = df.withColumn("is_new_build_strict", flag("old_new", "Y", "N"))
    return df.select(*ENRICHED_COLUMNS)


# --- slices of summaries -----------------------------------------------------

def slice_quarter_years(spark, sf_dir):
    # the year is a grouping key, so slicing the input first gives the same
    # cells and prunes the layer's year partitions before any median is ranked
    df = period_slice(sales(spark, sf_dir), years=SLICE_YEARS)
    return median_by(df, ["year", "quarter"], order=True)


def slice_premium_recent(spark, sf_dir):
    df = period_slice(sales(spark, sf_dir), since=SLICE_RECENT)
    return (premium(df, ["year", "property_type_name"], "is_new_build")
            .orderBy("year", "property_type_name"))


def slice_region_year(spark, sf_dir):
    joined = with_regions(period_slice(sales(spark, sf_dir), equals=SLICE_YEAR))
    return median_by(joined.filter(F.col("region").isNotNull()), ["region", "year"], order=True)


QUERIES: dict[str, Query] = {
    "cells_district_year": cells_district_year,
    "cells_district_type_year": cells_district_type_year,
    "cells_district_year_approx": cells_district_year_approx,
    "cells_quarter": cells_quarter,
    "national_year": national_year,
    "region_year": region_year,
    "trend_growth_district": trend_growth_district,
    "trend_growth": trend_growth,
    "trend_rolling3": trend_rolling3,
    "trend_rolling3_gappy": trend_rolling3_gappy,
    "latest_growth_top": latest_growth_top,
    "cohort_premium": cohort_premium,
    "cohort_premium_approx": cohort_premium_approx,
    "region_coverage": region_coverage,
    "join_strategy_parity": join_strategy_parity,
    "dimension_hygiene": dimension_hygiene_q,
    "group_counts_region": group_counts_region,
    "group_counts_district_year": group_counts_district_year,
    "group_counts_area": group_counts_area,
    "headline": headline_q,
    "skew_top10": skew_top10,
    "contract_check": contract_check,
    "quality_audit": quality_audit,
    "enriched_rows": enriched_rows,
    "slice_quarter_years": slice_quarter_years,
    "slice_premium_recent": slice_premium_recent,
    "slice_region_year": slice_region_year,
}


# --- layer, CSV feed, sinks and jobs -----------------------------------------
# The layer and the feed CSV are written once per session (see ``_once``);
# sinks and the full job write to fresh folders on every call.

LAYER_COLUMNS = [c for c in ENRICHED_COLUMNS if c != "is_new_build_strict"]
CELLS_SCHEMA = "district string, year int, median_price int, transactions long, mean_price long"




def layer_roundtrip(spark, sf_dir):
    return read_layer(spark, layer_path(spark, sf_dir)).select(*LAYER_COLUMNS)


def year_slice_type_count(spark, sf_dir):
    layer = read_layer(spark, layer_path(spark, sf_dir))
    return year_slice_counts(layer, YEAR_SLICE, by="property_type", period="year")


def year_slice_type_count_csv(spark, sf_dir):
    feed = read_feed_csv(spark, feed_csv_path(spark, sf_dir))
    return year_slice_counts(feed, YEAR_SLICE, by="property_type", ts="date_of_transfer")


def csv_roundtrip_cells(spark, sf_dir):
    feed = read_feed_csv(spark, feed_csv_path(spark, sf_dir))
    return cell_stats(enrich(apply_rules(feed)), ["district", "year"], min_rows=MIN_CELL_ROWS)


def csv_inferred_count(spark, sf_dir):
    """Rows and inferred types (column number and type, in order) of the feed CSV."""
    feed = read_feed_csv_inferred(spark, feed_csv_path(spark, sf_dir), sampling_ratio=0.1)
    types = ",".join(f.dataType.simpleString() for f in feed.schema)
    return feed.agg(F.count(F.lit(1)).alias("rows")).withColumns(
        {"columns": F.lit(len(feed.columns)), "types": F.lit(types)})


def _csv_output(name: str) -> Query:
    """B3: an output of the analysis from a CSV; one pass over the feed serves all."""
    def query(spark, sf_dir):
        feed = feed_csv_path(spark, sf_dir)
        staged = _once(spark, sf_dir, "csv-stage", lambda p: jobs.stage_csv(spark, feed, p))
        return jobs.csv_outputs(spark, staged, name, recent=SLICE_RECENT, years=SLICE_YEARS, one_year=SLICE_YEAR)[name]
    return query


CSV_OUTPUTS = ("quality", "headline", "national_year", "skew", "volume_quarter", "growth_district",
               "region_year", "join_parity", "fastest_growing", "premium_recent", "volume_years", "region_one_year")


def csv_summary_premium(spark, sf_dir):
    """B3: a summary straight from the feed CSV, no layer in between."""
    return jobs.summary_from_csv(spark, feed_csv_path(spark, sf_dir), "new_build_premium")


def summary_sink(spark, sf_dir):
    path = scratch_dir(spark, "summary")
    write_summary(cells_district_year(spark, sf_dir), path, name="cells_district_year")
    return read_summary(spark, path, CELLS_SCHEMA)


def run_report(spark, sf_dir):
    return jobs.run(spark, sales_view(spark, sf_dir), scratch_dir(spark, "layer"),
                    scratch_dir(spark, "outputs"))


def footprint_q(spark, sf_dir):
    """Whether the bytes that ``footprint`` lists for the feed CSV are the bytes of its
    lines, whether the layer is the smaller, and rows: sizes themselves differ by run."""
    paths = {"csv": feed_csv_path(spark, sf_dir), "parquet": layer_path(spark, sf_dir)}
    sizes = footprint(spark, paths, ratio_to="parquet")
    lines = spark.read.text(paths["csv"]).agg(
        F.sum(F.octet_length("value") + 1).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    csv, layer = (sizes.where(F.col("dataset") == x).select("bytes").scalar() for x in ("csv", "parquet"))
    return lines.select("rows", (F.col("bytes") == csv).alias("csv_bytes_agree"), (csv > layer).alias("layer_is_smaller"))


# --- sketches, quarantine, buckets, skew, periods from a table, settings, bytes ---

def sketch_medians(spark, sf_dir):
    """A1 by stored sketches: all-time medians of areas merged from the sketches of single years, and sketched anew
    from all rows; ``beyond_*`` counts areas whose median's rank is off by more than the bound."""
    df = sales(spark, sf_dir)
    stored = spark.read.parquet(_once(spark, sf_dir, "quantile-sketches", lambda p: sketch_quantiles(
        df, ["postcode_area"]).write.partitionBy("year").parquet(p)))
    whole = sketch_quantiles(df.withColumn("_all", F.lit(0)), ["postcode_area"], period="_all")
    found = {}
    for name, made in (("merged", stored), ("rescanned", whole)):
        errors = rank_errors(merged_quantiles(made, ["postcode_area"]), df, ["postcode_area"], "price")
        found[name] = errors.agg(F.count(F.lit(1)).alias("groups"), F.sum("rows").alias("rows"),
                                 F.count_if(F.col("error") > RANK_ERROR).alias(f"beyond_{name}"))
    return found["merged"].withColumn("beyond_rescanned", found["rescanned"].select("beyond_rescanned").scalar())


def sketch_distincts(spark, sf_dir):
    """A7 without ``Expand``: distinct districts, areas and streets from stored yearly sketches beside the exact counts,
    and whether each is within the stated error."""
    df, columns = sales(spark, sf_dir), ["district", "postcode_area", "street"]
    stored = spark.read.parquet(_once(spark, sf_dir, "distinct-sketches", lambda p: sketch_distinct(df, columns).write.partitionBy("year").parquet(p)))
    out = merged_distinct(stored, columns)
    for c in columns:
        exact = df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1))).scalar()
        out = out.withColumn(f"{c}_exact", exact).withColumn(
            f"{c}_within", F.abs(F.col(c) - F.col(f"{c}_exact")) <= F.ceil(F.lit(DISTINCT_ERROR) * F.col(f"{c}_exact")))
    return out.select(*[f"{c}_{x}" for c in columns for x in ("exact", "within")])


def marked_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of ``sf_dir`` with cells spoilt by rule (the transaction's order number): every 97th price is text,
    every 89th date has another format, every 83rd price is empty, every 79th line lacks its last cell."""
    def spoil(path):
        order = F.split("transaction_id", "-")[0].cast("long")
        raw = sales_view(spark, sf_dir).withColumn("_o", order)
        price = F.when(F.col("_o") % 83 == 0, F.lit("")).when(F.col("_o") % 97 == 0, F.lit("n/a")).otherwise(F.col("price").cast("string"))
        date = F.when(F.col("_o") % 89 == 0, F.date_format("date_of_transfer", "dd.MM.yyyy")).otherwise(F.date_format("date_of_transfer", "yyyy-MM-dd HH:mm"))
        cells = [{"price": price, "date_of_transfer": date}.get(c, F.col(c)) for c in FEED_COLUMNS]
        quoted = [F.concat(F.lit('"'), F.coalesce(c, F.lit("")), F.lit('"')) for c in cells]
        line = F.when(F.col("_o") % 79 == 0, F.concat_ws(",", *quoted[:-1])).otherwise(F.concat_ws(",", *quoted))
        raw.select(line.alias("value")).write.text(path)
    return read_feed_marked(spark, _once(spark, sf_dir, "spoilt-feed", spoil))


def feed_quarantine(spark, sf_dir):
    """S1: lines set aside by cause, apart from sound rows with missing cells."""
    return counts_by_cause(stage(marked_feed(spark, sf_dir), scratch_dir(spark, "quarantine")))


def join_bucketed_parity(spark, sf_dir):
    """J2 / J5 over the bucketed layer: the same rows as the broadcast join."""
    columns = ["transaction_id", "price", "year", "postcode_area"]
    df, dim = sales(spark, sf_dir).select(*columns), region_lookup(spark)
    path = scratch_dir(spark, "bucketed")
    layer = write_bucketed(df, path, "postcode_area", buckets=JOIN_BUCKETS)
    rows = [x.select(*columns, "region") for x in (with_regions(df), join_bucketed(spark, layer, dim, f"{path}/dim", *columns))]
    return strategy_parity(*rows, ["region"])


def join_skewed_rows(spark, sf_dir):
    """A15 / B8 as a join of rows: areas that hold more than ``HOT_SHARE`` of the sales are measured and salted."""
    df = sales(spark, sf_dir).select("transaction_id", "price", "postcode_area")
    hot = hot_keys(df, ["postcode_area"], HOT_SHARE).agg(F.count(F.lit(1))).scalar()
    salted = enrich_join(df, region_lookup(spark), "postcode_area", strategy="merge", hot_share=HOT_SHARE)
    return strategy_parity(with_regions(df), salted, ["region"]).withColumn("hot_areas", hot)


def slice_years_table(spark, sf_dir):
    """F12 with the years from a table: those with at least the average number of sales. The scan reads only their partitions."""
    path = _once(spark, sf_dir, "years", lambda p: sales(spark, sf_dir).groupBy("year").agg(F.count(F.lit(1)).alias("rows")).write.parquet(p))
    years = spark.read.parquet(path)
    busy = years.where(F.col("rows") >= years.agg(F.avg("rows")).scalar())
    return period_slice(sales(spark, sf_dir), table=busy).groupBy("year", "quarter").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("price").cast("long")).alias("total"))


SETTINGS = ({"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "7"},
            {"spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": "50"},
            {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "5", "spark.sql.autoBroadcastJoinThreshold": "-1"})


def settings_parity(spark, sf_dir):
    """B4, B7, B8: one grouped join of rows under each of ``SETTINGS``, in sessions of their own; the results agree."""
    layer, paths = layer_path(spark, sf_dir), []
    for settings in SETTINGS:
        own = isolated(spark, settings)
        joined = enrich_join(read_layer(own, layer).select("district", "year", "postcode_area"), region_lookup(own), "postcode_area", strategy="auto")
        paths.append(scratch_dir(spark, "settings"))
        joined.groupBy("district", "year", "region").agg(F.count(F.lit(1)).alias("rows")).write.parquet(paths[-1])
    first, *others = (spark.read.parquet(p) for p in paths)
    parts = [strategy_parity(first, x, ["district"]).withColumn("arm", F.lit(k)) for k, x in enumerate(others, 1)]
    return reduce(DataFrame.unionByName, parts)


def footprint_years(spark, sf_dir):
    """S8 by year: rows of each partition, and whether it has files and bytes and all bytes sum to the layer's."""
    path = layer_path(spark, sf_dir)
    by_year = footprint_by(read_layer(spark, path))
    whole = footprint(spark, {"layer": path}).select("bytes").scalar()
    total = by_year.agg(F.sum("bytes")).scalar()
    return by_year.select("year", "rows", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"), (total == whole).alias("sums_to_layer"))


def _rank_error(cells, keys, df):
    """Largest distance of a cell's sketch median from the middle rank, as a share of the
    cell's rows, compared with the sketch's bound (2 / accuracy)."""
    names = {k: f"_{k}" for k in keys}
    named = cells.select(*[F.col(k).alias(n) for k, n in names.items()], "median_price")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    v = F.col("median_price")
    ranks = df.join(named, on).groupBy(*names.values(), v).agg(
        F.count_if(F.col("price") < v).alias("below"), F.count_if(F.col("price") <= v).alias("upto"),
        F.count(F.lit(1)).alias("n"))
    off = F.greatest(F.col("below") - F.col("n") / 2, F.col("n") / 2 - F.col("upto"), F.lit(0.0))
    return ranks.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("rows"),
                     F.count_if(off > F.lit(2.0 / MEDIAN_ACCURACY) * F.col("n") + 1).alias("beyond_bound"))


QUERIES.update({
    "layer_roundtrip": layer_roundtrip,
    "year_slice_type_count": year_slice_type_count,
    "year_slice_type_count_csv": year_slice_type_count_csv,
    "csv_roundtrip_cells": csv_roundtrip_cells,
    "csv_inferred_count": csv_inferred_count,
    "csv_summary_premium": csv_summary_premium,
    **{f"csv_{name}": _csv_output(name) for name in CSV_OUTPUTS},
    "summary_sink": summary_sink,
    "run_report": run_report,
    "footprint": footprint_q,
    "sketch_medians": sketch_medians,
    "sketch_distincts": sketch_distincts,
    "feed_quarantine": feed_quarantine,
    "join_bucketed_parity": join_bucketed_parity,
    "join_skewed_rows": join_skewed_rows,
    "slice_years_table": slice_years_table,
    "settings_parity": settings_parity,
    "footprint_years": footprint_years,
})
