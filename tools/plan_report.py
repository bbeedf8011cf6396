"""Write PLANS.md: the physical plan shape of every registered query, and the
formatted plans of a few representative ones.

    python tools/plan_report.py [SF_DIR]
"""
from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SHOW = ("cells_district_year", "trend_growth", "cohort_premium", "latest_growth_top",
        "region_year", "skew_top10", "year_slice_type_count", "year_slice_type_count_csv")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.maxMetadataStringLength", "400")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from brickyard.catalog import QUERIES
    from brickyard.plans.inspect import shape

    lines = ["# PLANS", "",
             f"Physical plans (AQE initial plans, before execution) on `{sf_dir}`, "
             "local[8], 16 shuffle partitions. Generated by `tools/plan_report.py`.", "",
             "Counts are for the plan the query returns.", "",
             "| query | scans | exchanges | broadcast joins | sort-merge joins | windows | sorts |",
             "| --- | --- | --- | --- | --- | --- | --- |"]
    plans = {}
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        s = shape(df)
        lines.append(f"| `{name}` | {s['scans']} | {s['exchanges']} | {s['broadcast_joins']} | "
                     f"{s['sort_merge_joins']} | {s['windows']} | {s['sorts']} |")
        if name in SHOW:
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                df.explain("formatted")
            plans[name] = buf.getvalue()
    from brickyard.plans.jobs import ingest_frame
    from brickyard.sources.sales import sales_view
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        ingest_frame(sales_view(spark, sf_dir))[0].explain("formatted")
    plans["ingest (rows written to the layer)"] = buf.getvalue()
    for name, text in plans.items():
        lines += ["", f"## `{name}`", "", "```", text.strip(), "```"]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
