"""Property tests of the trend frames, and the jobs end to end on edge rows."""
from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brickyard.functions import apply_rules, audit, enrich
from brickyard.operators import growth, headline, rolling_mean
from brickyard.plans import jobs
from brickyard.plans.inspect import physical_plan
from brickyard.sources.contract import check_contract, read_feed_csv, write_feed_csv
from brickyard.sources.layer import read_layer, read_summary, scratch_dir, write_layer, write_summary

from .conftest import DROPPED, KEPT, frame, made

cells_strategy = st.dictionaries(
    keys=st.tuples(st.sampled_from(["a", "b"]), st.integers(1995, 2005)),
    values=st.integers(1, 1000), min_size=1, max_size=20)


def _pct(new, base):
    """Spark's ``round``: half-up on the double's shortest decimal text."""
    if base is None:
        return None
    x = 100.0 * (new - base) / base
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cells_strategy)
def test_growth_matches_definition(spark, cells):
    rows = [(e, y, m) for (e, y), m in cells.items()]
    df = spark.createDataFrame(rows, "district string, year int, median_price int")
    got = {(r["district"], r["year"]): r for r in growth(df, "district").collect()}
    for (e, y), m in cells.items():
        prev = cells.get((e, y - 1))
        first = cells[(e, min(yy for (ee, yy) in cells if ee == e))]
        r = got[(e, y)]
        assert r["prev_median"] == prev and r["first_median"] == first
        assert r["yoy_pct"] == _pct(m, prev)
        assert r["cumulative_growth_pct"] == _pct(m, first)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cells_strategy, st.integers(1, 4))
def test_rolling_mean_matches_definition(spark, cells, periods):
    rows = [(e, y, m) for (e, y), m in cells.items()]
    df = spark.createDataFrame(rows, "area string, year int, median_price int")
    got = {(r["area"], r["year"]): r["rolling_avg_median"]
           for r in rolling_mean(df, "area", periods=periods).collect()}
    for (e, y) in cells:
        window = [m for (ee, yy), m in cells.items() if ee == e and y - periods < yy <= y]
        mean = sum(window) / len(window)
        assert abs(got[(e, y)] - mean) <= 0.5 + 1e-9


def test_contract_check_counts_null_keys(spark, sample_df):
    extra = frame(spark, [made()])
    extra = extra.withColumn("transaction_id", F.lit(None).cast("string"))
    df = sample_df.unionByName(extra)
    row = check_contract(df).first()
    assert (row["missing_columns"], row["null_keys"], row["rows"]) == (0, 1, len(KEPT | DROPPED) + 1)
    assert check_contract(df.drop("county")).first()["missing_columns"] == 1


def test_summary_limit_and_range_clustered_layer(spark, sample_df):
    clean = enrich(apply_rules(sample_df))
    path = scratch_dir(spark, "test-sink")
    assert write_summary(clean.orderBy("price"), path, limit=3) == 3
    assert read_summary(spark, path, clean.select("price").schema).count() == 3
    lpath = scratch_dir(spark, "test-range")
    write_layer(clean, lpath, range_cluster="transfer_date")
    assert read_layer(spark, lpath).count() == len(KEPT)


def test_job_run_reports_every_output(spark, sample_df):
    csv, out = scratch_dir(spark, "test-run-csv"), scratch_dir(spark, "test-run-out")
    write_feed_csv(sample_df, csv)
    report = {r["name"]: r["value"] for r in jobs.run(
        spark, read_feed_csv(spark, csv), scratch_dir(spark, "test-run-layer"), out, csv_path=csv).collect()}
    clean = enrich(apply_rules(sample_df))
    assert report["ingest_rows_raw"] == len(KEPT | DROPPED) and report["ingest_rows_clean"] == len(KEPT)
    assert report["ingest_pct_dropped"] == round(100 * len(DROPPED) / len(KEPT | DROPPED), 4)
    assert set(f"output_{n}" for n in jobs.SUMMARY_NAMES) <= set(report)
    assert report["output_median_price_by_district_year"] == 0  # every cell under the floor
    assert report["output_transaction_volume_by_quarter"] == clean.select("year", "quarter").distinct().count()
    assert (report["headline_year_min"], report["headline_year_max"]) == (1996, 2007)
    assert report["skew_rows_OX"] == len(KEPT) - 1 and report["skew_rows_None"] == 1
    stored = {r["name"] for r in spark.read.json(f"{out}/_report").collect()}
    assert {"seconds_ingest", "seconds_cells", "bytes_layer", "bytes_csv", "csv_to_layer_ratio"} <= stored - set(report)


def test_outputs_from_cells_equal_those_from_rows(spark):
    from .conftest import yearly
    df = enrich(apply_rules(frame(spark, yearly({1998: 40_000, 2001: 55_000, 2002: 61_000}) + yearly(
        {2000: 30_000, 2001: 33_000}, district="Other"))))
    cells = jobs.district_cells(df)
    for name in jobs.FROM_CELLS:
        a, b = jobs.summary(df, name), jobs.summary(df, name, cells=cells)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def test_outputs_from_csv_share_one_pass(spark, sample_df):
    csv, work = scratch_dir(spark, "test-csv"), scratch_dir(spark, "test-stage")
    write_feed_csv(sample_df, csv)
    jobs.stage_csv(spark, csv, work)
    out = jobs.csv_outputs(spark, work)
    assert out["quality"].first().asDict() == audit(sample_df).first().asDict()
    assert out["headline"].first() == headline(enrich(apply_rules(sample_df))).first()
    assert out["join_parity"].first()["groups_differing"] == 0
    assert all("csv" not in physical_plan(df).split("Location")[0].lower() for df in out.values())


def test_summary_from_csv_equals_summary_from_layer(spark, sample_df):
    path = scratch_dir(spark, "test-feed")
    write_feed_csv(sample_df, path)
    a = jobs.summary_from_csv(spark, path, "transaction_volume_by_quarter")
    b = jobs.summary(enrich(apply_rules(sample_df)), "transaction_volume_by_quarter")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.filter(F.col("median_price").isNull()).count() == 0
