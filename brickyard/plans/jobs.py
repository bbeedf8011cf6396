"""Jobs: ingest a feed into the columnar layer, summarise the layer.

Each job is a plain function taking DataFrames / paths and returning a small
report; there is no session building and no argument parsing. Outputs are
written tables, so a lost executor costs a task retry, never a recomputation
from the raw feed by a later job.
"""
from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import apply_rules, enrich
from ..functions.rules import Rule, audit_columns, finish_audit, price_paid_rules
from ..operators import (
    cell_stats, enrich_join, growth, latest_growth, median_by, premium, rolling_mean, strategy_parity,
)
from ..operators.cohort import fold_cohorts
from ..operators.cube import Cube, build_cube, read_cube
from ..operators.profile import headline, skew_profile
from ..operators.slices import period_slice
from ..sources.contract import read_feed_csv
from ..sources.layer import (
    discard, footprint, publish, read_layer, replace_years, write_layer, write_summary,
)
from ..sources.regions import region_lookup

SKEW_KEYS = 10
CSV_TOP_N = 15


def ingest(raw: DataFrame, path: str, *, rules: Sequence[Rule] | None = None,
           partition_by: str | None = "year", layout: str = "rebalance") -> dict[str, int]:
    """Clean, enrich and write ``raw`` as a partitioned layer at ``path``.

    The rows go to a staging folder beside it, are counted there, and take the place of
    ``path`` only then: an ingest that fails leaves the layer that was there.

    The cleaning audit (raw, clean and per-rule failure counts) is observed on the
    pass that feeds the write, below the filter; only clean rows are laid out by the
    partition column (``rebalance``, see ``write_layer``). The observation sits in the
    stage before that shuffle: should the stage run again after a lost executor, Spark
    may add its counts twice, so ``ingest`` compares them with a count of the written
    rows (Parquet footers) and raises where they differ. ``layout="map"`` writes
    without a shuffle, right for input in date order.
    """
    spark, staged = raw.sparkSession, f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    rows, obs = ingest_frame(raw, rules=rules, partition_by=partition_by, layout=layout)
    try:
        write_layer(rows, staged, partition_by=partition_by, layout="map")
        audit = {k: int(v) for k, v in obs.get.items()}
        stored = read_layer(spark, staged).count() if audit["rows_clean"] else 0
        if stored != audit["rows_clean"]:
            raise RuntimeError(f"{stored} rows were written, {audit['rows_clean']} observed as clean; "
                               "count again with rules.audit")
        publish(spark, staged, path)
    except BaseException:
        discard(spark, staged)
        raise
    return audit


def ingest_years(raw: DataFrame, path: str, years: Sequence[int], *, rules: Sequence[Rule] | None = None) -> int:
    """Clean and enrich ``raw``, keep the rows of ``years`` and put them in the place of these years of the layer
    at ``path``; all other years stay as they are. Returns the rows now stored for these years."""
    rows = enrich(apply_rules(raw, rules)).where(F.col("year").isin(*years))
    replace_years(rows, path, years)
    return read_layer(raw.sparkSession, path).where(F.col("year").isin(*years)).count()


def ingest_frame(raw: DataFrame, *, rules: Sequence[Rule] | None = None,
                 partition_by: str | None = "year", layout: str = "rebalance",
                 ) -> tuple[DataFrame, Observation]:
    """The rows ``ingest`` writes, and the observation that will hold its audit
    once they are written (see ``ingest`` for the order of the steps)."""
    full, plain = enrich(raw), rules is None                    # (the feed's own rules read no derived column)
    rules = price_paid_rules() if plain else list(rules)
    obs = Observation(f"ingest-audit-{uuid.uuid4().hex}")   # unique per concurrent ingest
    aqe = raw.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") == "true"
    if layout != "rebalance" or not aqe or not partition_by:
        return apply_rules(full.observe(obs, *audit_columns(rules)), rules), obs
    # only the feed's columns cross the shuffle; derived ones are made again behind it
    kept = [*raw.columns, *[c for c in [partition_by] if c not in raw.columns]]
    rows = apply_rules((full.select(*kept) if plain else full).observe(obs, *audit_columns(rules)), rules)
    rows = enrich(rows.select(*kept).hint("rebalance", partition_by)).select(*full.columns)
    return rows, obs


SUMMARY_NAMES = (
    "median_price_by_district_year", "price_growth_by_district", "rolling_median_by_area",
    "new_build_premium", "transaction_volume_by_quarter", "region_summary",
    "fastest_growing_districts",
)
#: Summaries that follow from the district-year cells alone.
FROM_CELLS = ("median_price_by_district_year", "price_growth_by_district", "fastest_growing_districts")


def district_cells(df: DataFrame) -> DataFrame:
    return cell_stats(df, ["district", "year"], min_rows=30)


def summary(df: DataFrame, name: str, *, since_year: int = 2000, top_n: int = 20,
            window_years: int = 3, cells: DataFrame | None = None) -> DataFrame:
    """One of the seven market summaries over clean, enriched sales. ``cells``: their
    district-year cells, if the caller has them stored (the base-year cut is on a
    grouping key, so it commutes with the aggregation)."""
    if name in FROM_CELLS:
        cells = district_cells(df) if cells is None else cells
        if name == "price_growth_by_district":
            return growth(cells, "district")
        if name == "fastest_growing_districts":
            return latest_growth(cells.filter(F.col("year") >= since_year), "district", top_n=top_n)
        return cells
    if name == "rolling_median_by_area":
        return rolling_mean(median_by(df, ["postcode_area", "year"]), "postcode_area",
                            periods=window_years)
    if name == "new_build_premium":
        return premium(df, ["year", "property_type_name"], "is_new_build")
    if name == "transaction_volume_by_quarter":
        return median_by(df, ["year", "quarter"], order=True)
    if name == "region_summary":
        joined = enrich_join(df, region_lookup(df.sparkSession), "postcode_area")
        return median_by(joined.filter(F.col("region").isNotNull()), ["region", "year"], order=True)
    raise ValueError(f"unknown summary {name!r}")


def summary_from_cube(cube: Cube, name: str, *, since_year: int = 2000, top_n: int = 20, window_years: int = 3) -> DataFrame:
    """One of the seven market summaries from the stored percentiles of a cube: equal to ``summary`` over the rows
    that the cube counts, without reading them."""
    if name in FROM_CELLS:
        return summary(cube.percentiles, name, since_year=since_year, top_n=top_n,
                       cells=cube.cells("district", min_rows=30, with_mean=True))
    if name == "rolling_median_by_area":
        return rolling_mean(cube.cells("area"), "postcode_area", periods=window_years)
    if name == "new_build_premium":
        return fold_cohorts(cube.cells("cohort"), ["year", "property_type_name"], "is_new_build", median="median_price")
    if name == "transaction_volume_by_quarter":
        return cube.cells("quarter").orderBy("year", "quarter")
    if name == "region_summary":
        return cube.cells("region").filter(F.col("region").isNotNull()).orderBy("region", "year")
    raise ValueError(f"unknown summary {name!r}")


def summaries(df: DataFrame, **params) -> dict[str, DataFrame]:
    """All seven summaries."""
    return {name: summary(df, name, **params) for name in SUMMARY_NAMES}


def summary_from_csv(spark: SparkSession, csv_path: str, name: str, **params) -> DataFrame:
    """A summary straight from a feed CSV (no layer): the operators take any
    DataFrame in the contract, so only the source changes."""
    return summary(enrich(apply_rules(read_feed_csv(spark, csv_path))), name, **params)


def stage_csv(spark: SparkSession, csv_path: str, work_dir: str) -> None:
    """The one pass over a feed CSV that all outputs of ``csv_outputs`` share: its clean,
    enriched rows and its audit, under ``work_dir``."""
    counts = ingest(read_feed_csv(spark, csv_path), f"{work_dir}/rows", layout="map", partition_by=None)
    row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts))
    finish_audit(row, price_paid_rules()).coalesce(1).write.mode("overwrite").parquet(f"{work_dir}/audit")   # one row


def csv_outputs(spark: SparkSession, work_dir: str, *names: str, recent: int = 2020,
                years: Sequence[int] = (2007, 2008, 2009, 2019, 2020, 2021), one_year: int = 2024) -> dict[str, DataFrame]:
    """Every output of the analysis from a CSV (or those named), over what ``stage_csv`` stored; ``recent``, ``years``
    and ``one_year`` are the years of its three slices."""
    df = read_layer(spark, f"{work_dir}/rows")

    def parity() -> DataFrame:
        dim, own = region_lookup(spark), df.select("transaction_id", "price", "year", "postcode_area")
        return strategy_parity(*(enrich_join(own, dim, "postcode_area", strategy=s) for s in ("broadcast", "merge")), ["region"])

    outputs = {
        "quality": lambda: spark.read.parquet(f"{work_dir}/audit"),
        "headline": lambda: headline(df),
        "national_year": lambda: median_by(df, ["year"], order=True),
        "skew": lambda: skew_profile(df, "postcode_area", SKEW_KEYS),
        "volume_quarter": lambda: summary(df, "transaction_volume_by_quarter"),
        "growth_district": lambda: summary(df, "price_growth_by_district"),
        "region_year": lambda: summary(df, "region_summary"),
        "join_parity": parity,
        "fastest_growing": lambda: summary(df, "fastest_growing_districts", since_year=2000, top_n=CSV_TOP_N),
        "premium_recent": lambda: summary(period_slice(df, since=recent), "new_build_premium").orderBy("year", "property_type_name"),
        "volume_years": lambda: summary(period_slice(df, years=years), "transaction_volume_by_quarter"),
        "region_one_year": lambda: summary(period_slice(df, equals=one_year), "region_summary"),
    }
    return {name: outputs[name]() for name in names or outputs}


def analyse(layer: DataFrame, out_root: str, *, parallel: int = 4,
            seconds: dict[str, float] | None = None) -> dict[str, int]:
    """Write every summary under ``out_root`` and return rows written per output.

    The layer is read once, for the cube of counts (``operators.cube``, kept under
    ``out_root/_cube``); all seven outputs follow from its stored percentiles. Each write
    observes its own row count (one job per output, no cache). The outputs are
    independent, so up to ``parallel`` of them are submitted at once from a thread pool.
    ``seconds`` receives timings.
    """
    seconds = {} if seconds is None else seconds
    began = time.perf_counter()
    cube = build_cube(layer, f"{out_root}/_cube", dim=region_lookup(layer.sparkSession))
    seconds["cells"] = time.perf_counter() - began

    def one(name: str) -> tuple[str, int]:
        began = time.perf_counter()
        rows = write_summary(summary_from_cube(cube, name), f"{out_root}/{name}", name=name)
        seconds[f"output_{name}"] = time.perf_counter() - began
        return name, rows

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return dict(pool.map(one, SUMMARY_NAMES))


def report_frame(spark: SparkSession, report: dict[str, float]) -> DataFrame:
    """A job report as a DataFrame: one row per entry, ``name`` and ``value``."""
    return spark.createDataFrame([(k, float(v)) for k, v in report.items()], "name string, value double")


def run(spark: SparkSession, raw: DataFrame, layer_path: str, out_root: str, *,
        csv_path: str | None = None) -> DataFrame:
    """Ingest then analyse; the report of both as one DataFrame.

    It holds the audit with the share of dropped rows, rows per output, the headline
    with the range of years and the all-time median, and the ten commonest postcode
    areas with their rows and shares. The stored JSON adds what changes from run to
    run: seconds by step, bytes of the layer and, with ``csv_path``, of the feed and
    their ratio.
    """
    seconds: dict[str, float] = {}
    began = time.perf_counter()
    audit = ingest(raw, layer_path)
    seconds["ingest"] = time.perf_counter() - began
    layer = read_layer(spark, layer_path)
    written = analyse(layer, out_root, seconds=seconds)
    dropped = audit["rows_raw"] - audit["rows_clean"]
    report: dict[str, float] = {
        "ingest_rows_raw": audit["rows_raw"], "ingest_rows_clean": audit["rows_clean"],
        "ingest_rows_dropped": dropped,
        "ingest_pct_dropped": round(100.0 * dropped / audit["rows_raw"], 4) if audit["rows_raw"] else 0.0}
    report.update({f"output_{k}": v for k, v in written.items()})
    cube = read_cube(spark, f"{out_root}/_cube")
    head = cube.headline().first().asDict()
    report.update({f"headline_{k}": v for k, v in head.items() if v is not None})
    for r in cube.skew(top_n=SKEW_KEYS).collect():                     # ten rows
        report[f"skew_rows_{r['postcode_area']}"] = r["rows"]
        report[f"skew_pct_{r['postcode_area']}"] = r["pct_of_total"]
    places = {"layer": layer_path} | ({"csv": csv_path} if csv_path else {})
    size = {r["dataset"]: r["bytes"] for r in footprint(spark, places).collect()}
    varying = {f"seconds_{k}": v for k, v in seconds.items()} | {f"bytes_{k}": v for k, v in size.items()}
    if csv_path and size["layer"]:
        varying["csv_to_layer_ratio"] = round(size["csv"] / size["layer"], 2)
    report_frame(spark, report | varying).coalesce(1).write.mode("overwrite").json(f"{out_root}/_report")   # a few rows
    return report_frame(spark, report)
