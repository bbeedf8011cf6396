"""Independent SQL (DuckDB dialect) for every registered query.

Written from the operator *definitions*, not from the Spark code: medians are
``quantile_disc(…, 0.5)``, windows are SQL window frames, joins are joins. The
sales projection below mirrors ``sources.sales`` column by column; tables
``lineitem orders customer nation region part`` are views over the same
Parquet files the Spark side reads.
"""
from __future__ import annotations

# --- fixed values: stated here again, so that a wrong constant in the package shows ---
LIVE_STATUSES = ("A", "C")
MIN_PLAUSIBLE_PRICE = 1000
MAX_PLAUSIBLE_PRICE = 50000000
PROPERTY_TYPES = {"D": "Detached", "S": "Semi-Detached", "T": "Terraced", "F": "Flat/Maisonette", "O": "Other"}
DURATIONS = {"F": "Freehold", "L": "Leasehold", "U": "Unknown"}
PPD_CATEGORIES = {"A": "Standard Price Paid", "B": "Additional Price Paid"}
AREA_BY_NATION = [
    "SW", "M", "LS", "B", "CF", "NE", "L", "BS", "E", "N", "NG", "TD", "EH",
    "ZZ", "-", "OX", "CB", "YO", "SE", "W", "CH", "PL", "PE", "S", "GU",
]
TYPE_BY_PART_WORD = {"ECONOMY": "D", "PROMO": "S", "LARGE": "T", "MEDIUM": "F", "STANDARD": "O", "SMALL": "X"}
OLD_NEW_BY_RETURNFLAG = {"N": "Y", "A": "N"}
DURATION_BY_LINESTATUS = {"F": "F", "O": "L"}
STATUS_BY_ORDERSTATUS = {"F": "A", "O": "C", "P": "D"}
CATEGORY_B_PRIORITIES = ("1-URGENT", "2-HIGH")
REGIONS_OF = {
    "East Midlands": "DE LE LN NG NN",
    "East of England": "AL CB CM CO IP LU NR PE SG SS WD",
    "London": "BR CR DA E EC EN HA IG N NW RM SE SM SW TW UB W WC",
    "North East": "DH DL NE SR TD TS",
    "North West": "BB BL CA CH CW FY L LA M OL PR SK WA WN",
    "Northern Ireland": "BT",
    "Scotland": "AB DD DG EH FK G HS IV KA KW KY ML PA PH ZE",
    "South East": "BN CT GU HP KT ME MK OX PO RG RH SL SO TN",
    "South West": "BA BH BS DT EX GL PL SN SP TA TQ TR",
    "Wales": "CF LD LL NP SA SY",
    "West Midlands": "B CV DY HR ST TF WR WS WV",
    "Yorkshire": "BD DN HD HG HU HX LS S WF YO",
}


def _q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _case(expr: str, table: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in table.items())
    return f"CASE {expr} {whens} END"


def _areas() -> str:
    rows = ", ".join(f"({i}, {_q(None if a == '-' else a)})" for i, a in enumerate(AREA_BY_NATION))
    return f"(VALUES {rows}) AS ga(nk, area)"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


SALES_RAW = f"""
sales_raw AS (
  SELECT
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
    CAST(floor(l.l_extendedprice) AS INTEGER) AS price,
    l.l_shipdate AS date_of_transfer,
    ga.area || CAST(1 + l.l_suppkey % 9 AS VARCHAR) || ' 1AA' AS postcode,
    {_case("split_part(p.p_type, ' ', 1)", TYPE_BY_PART_WORD)} AS property_type,
    {_case("l.l_returnflag", OLD_NEW_BY_RETURNFLAG)} AS old_new,
    {_case("l.l_linestatus", DURATION_BY_LINESTATUS)} AS duration,
    CAST(NULL AS VARCHAR) AS paon,
    CAST(NULL AS VARCHAR) AS saon,
    p.p_name AS street,
    CAST(NULL AS VARCHAR) AS locality,
    c.c_mktsegment AS town_city,
    n.n_name AS district,
    r.r_name AS county,
    CASE WHEN o.o_orderpriority IN {_in(CATEGORY_B_PRIORITIES)} THEN 'B' ELSE 'A' END AS ppd_category_type,
    {_case("o.o_orderstatus", STATUS_BY_ORDERSTATUS)} AS record_status
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN {_areas()} ON ga.nk = c.c_nationkey
)"""

DERIVED = f"""
    CAST(date_of_transfer AS DATE) AS transfer_date,
    CAST(year(date_of_transfer) AS INTEGER) AS year,
    CAST(month(date_of_transfer) AS INTEGER) AS month,
    CAST(quarter(date_of_transfer) AS INTEGER) AS quarter,
    NULLIF(upper(regexp_extract(coalesce(postcode, ''), '^([A-Za-z]{{1,2}})', 1)), '') AS postcode_area,
    (old_new = 'Y') AS is_new_build,
    {_case("property_type", PROPERTY_TYPES)} AS property_type_name,
    {_case("duration", DURATIONS)} AS duration_name,
    {_case("ppd_category_type", PPD_CATEGORIES)} AS ppd_category_name"""

CLEAN = (f"record_status IN {_in(LIVE_STATUSES)} AND price IS NOT NULL "
         f"AND price BETWEEN {MIN_PLAUSIBLE_PRICE} AND {MAX_PLAUSIBLE_PRICE} "
         f"AND date_of_transfer IS NOT NULL")

SALES = f"""
sales AS (
  SELECT *, {DERIVED}
  FROM sales_raw
  WHERE {CLEAN}
)"""

REGION_ROWS = ", ".join(f"('{area}', '{region}')" for region, areas in REGIONS_OF.items() for area in areas.split())
REGIONS = f"regions AS (SELECT * FROM (VALUES {REGION_ROWS}) AS r(postcode_area, region))"

SALES_REGION = """
sales_region AS (
  SELECT s.*, g.region FROM sales s LEFT JOIN regions g ON s.postcode_area = g.postcode_area
)"""


def with_sales(body: str, *extra: str) -> str:
    ctes = [SALES_RAW, SALES, REGIONS, SALES_REGION, *extra]
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()


def pct(new: str, base: str, digits: int = 2) -> str:
    """Percentage change, rounded. Spark rounds through BigDecimal, which has
    no negative zero (-0.004 → 0.0); DuckDB keeps -0.0. Adding 0.0 maps -0.0
    to 0.0 and leaves every other value unchanged."""
    return f"(round(100.0::DOUBLE * ({new} - {base}) / {base}, {digits}) + 0.0)"


def cells(keys: str, floor: int | None = 30, where: str = "", mean: bool = True,
          src: str = "sales") -> str:
    mean_col = ", CAST(trunc(avg(price)) AS BIGINT) AS mean_price" if mean else ""
    having = f"HAVING count(*) >= {floor}" if floor else ""
    w = f"WHERE {where}" if where else ""
    return (f"SELECT {keys}, quantile_disc(price, 0.5) AS median_price, "
            f"count(*) AS transactions{mean_col} FROM {src} {w} GROUP BY {keys} {having}")


def growth(entity: str, floor: int = 30, where: str = "") -> str:
    """Cells over (entity, year) with prior-year and first-year growth."""
    cte = f"cells AS ({cells(entity + ', year', floor, where)})"
    body = f"""
SELECT *, {pct('median_price', 'prev_median')} AS yoy_pct,
          {pct('median_price', 'first_median')} AS cumulative_growth_pct
FROM (
  SELECT *,
    max(median_price) OVER (PARTITION BY {entity} ORDER BY year
                            RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS prev_median,
    first_value(median_price) OVER (PARTITION BY {entity} ORDER BY year
                            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_median
  FROM cells
) t"""
    return with_sales(body, cte)


def rolling(entity: str, floor: int | None, years: int = 3) -> str:
    cte = f"cells AS ({cells(entity + ', year', floor, mean=False)})"
    body = f"""
SELECT *, round(avg(median_price) OVER (PARTITION BY {entity} ORDER BY year
                 RANGE BETWEEN {years - 1} PRECEDING AND CURRENT ROW), 0) AS rolling_avg_median
FROM cells"""
    return with_sales(body, cte)


PREMIUM = """
premium AS (
  SELECT n.year, n.property_type_name,
         n.median_price AS new_build_median,
         o.median_price AS existing_median,
         (round(100.0::DOUBLE * (n.median_price - o.median_price) / o.median_price, 2) + 0.0)
           AS premium_pct,
         n.transactions AS new_build_transactions
  FROM (SELECT year, property_type_name, quantile_disc(price, 0.5) AS median_price, count(*) AS transactions
        FROM sales WHERE is_new_build GROUP BY ALL) n
  JOIN (SELECT year, property_type_name, quantile_disc(price, 0.5) AS median_price
        FROM sales WHERE NOT is_new_build GROUP BY ALL) o
    ON n.year = o.year AND n.property_type_name = o.property_type_name
)"""

QUARTER = f"quarter_cells AS ({cells('year, quarter', None, mean=False)})"
REGION_YEAR = (f"region_year AS ({cells('region, year', None, where='region IS NOT NULL', mean=False, src='sales_region')})")


def latest_growth(since: int, top_n: int) -> str:
    cte = f"cells AS ({cells('district, year', 30, where=f'year >= {since}')})"
    body = f"""
SELECT district, year, median_price, cumulative_growth_pct, transactions FROM (
  SELECT *, {pct('median_price', 'first_median')} AS cumulative_growth_pct FROM (
    SELECT *,
      first_value(median_price) OVER (PARTITION BY district ORDER BY year
          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_median,
      max(year) OVER (PARTITION BY district) AS latest_year
    FROM cells
  ) a WHERE year = latest_year AND district IS NOT NULL
) b
ORDER BY cumulative_growth_pct DESC NULLS LAST, district ASC
LIMIT {top_n}"""
    return with_sales(body, cte)


def skew(key: str, top_n: int) -> str:
    body = f"""
SELECT {key}, rows, round(100.0::DOUBLE * rows / sum(rows) OVER (), 3) AS pct_of_total
FROM (SELECT {key}, count(*) AS rows FROM sales GROUP BY {key}) g
ORDER BY rows DESC, {key} ASC NULLS FIRST
LIMIT {top_n}"""
    return with_sales(body)


def _regions_in() -> str:
    return _in(REGIONS_OF)


QUALITY = f"""
SELECT count(*) AS rows_raw,
       count_if(ok) AS rows_clean,
       count(*) - count_if(ok) AS rows_dropped,
       CASE WHEN count(*) > 0 THEN round(100.0::DOUBLE * (count(*) - count_if(ok)) / count(*), 4)
            ELSE 0.0 END AS pct_dropped,
       count_if(NOT coalesce(record_status IN {_in(LIVE_STATUSES)}, false)) AS failed_live_status,
       count_if(price IS NULL) AS failed_price_present,
       count_if(NOT coalesce(price BETWEEN {MIN_PLAUSIBLE_PRICE} AND {MAX_PLAUSIBLE_PRICE}, false))
         AS failed_price_plausible,
       count_if(date_of_transfer IS NULL) AS failed_date_present
FROM (SELECT *, coalesce({CLEAN}, false) AS ok FROM sales_raw) t"""

COVERAGE = """
SELECT count(*) AS rows,
       count_if(region IS NOT NULL) AS matched_rows,
       count_if(postcode_area IS NOT NULL AND region IS NULL) AS unmatched_rows,
       count_if(postcode_area IS NULL) AS null_key_rows,
       count(DISTINCT CASE WHEN region IS NULL THEN postcode_area END) AS unmatched_keys,
       round(100.0::DOUBLE * count_if(region IS NOT NULL) / count(*), 3) AS matched_pct
FROM sales_region"""

PARITY = """
SELECT (SELECT count(*) FROM sales_region) AS rows_a,
       (SELECT count(*) FROM sales) AS rows_b,
       (SELECT count(*) FROM (SELECT region FROM sales_region GROUP BY region) g) AS groups,
       (SELECT count(*) FROM (SELECT region, count(*) AS n FROM sales_region GROUP BY region) a
        FULL JOIN (SELECT (SELECT g.region FROM regions g WHERE g.postcode_area = s.postcode_area) AS region,
                          count(*) AS n FROM sales s GROUP BY 1) b
          ON a.region IS NOT DISTINCT FROM b.region
        WHERE a.n IS DISTINCT FROM b.n) AS groups_differing"""


HOT_AREAS = """
       (SELECT count(*) FROM (SELECT postcode_area, count(*) AS n FROM sales GROUP BY 1) a
        WHERE postcode_area IS NOT NULL AND n > 0.045::DOUBLE * (SELECT count(*) FROM sales)) AS hot_areas"""

QUARANTINE = """
SELECT cause, rows FROM (
  SELECT count_if(o % 79 = 0) AS columns, count_if(o % 97 = 0 AND o % 83 <> 0) AS price, count_if(o % 89 = 0) AS date_of_transfer,
         count_if(o % 83 = 0 AND o % 89 <> 0 AND o % 79 <> 0) AS "missing price", CAST(0 AS BIGINT) AS "missing date_of_transfer"
  FROM (SELECT CAST(split_part(transaction_id, '-', 1) AS BIGINT) AS o FROM sales_raw) t)
UNPIVOT (rows FOR cause IN (columns, price, date_of_transfer, "missing price", "missing date_of_transfer"))"""


def _hygiene() -> str:
    return f"""
SELECT (SELECT count(*) FROM regions) AS dim_rows,
       (SELECT count(DISTINCT postcode_area) FROM regions) AS distinct_keys,
       (SELECT count(*) FROM (SELECT postcode_area FROM regions GROUP BY 1 HAVING count(*) > 1) d)
         AS duplicate_keys,
       (SELECT count_if(NOT coalesce(regexp_full_match(postcode_area, '[A-Z]{{1,2}}'), false))
          FROM regions) AS malformed_keys,
       (SELECT count_if(NOT coalesce(region IN {_regions_in()}, false)) FROM regions)
         AS values_outside_set,
       (SELECT count(*) FROM (SELECT DISTINCT postcode_area FROM sales
                              WHERE postcode_area IS NOT NULL) s
         WHERE postcode_area NOT IN (SELECT postcode_area FROM regions)) AS sales_areas_missing"""


ENRICHED = """
SELECT transaction_id, price, date_of_transfer, postcode, district, record_status,
       transfer_date, year, month, quarter, postcode_area, is_new_build,
       CASE old_new WHEN 'Y' THEN true WHEN 'N' THEN false END AS is_new_build_strict,
       property_type_name, duration_name, ppd_category_name
FROM sales"""

HEADLINE = """
SELECT count(*) AS total_rows, min(year) AS year_min, max(year) AS year_max,
       count(DISTINCT district) AS districts, count(DISTINCT postcode_area) AS postcode_areas,
       quantile_disc(price, 0.5) AS median_price_all_time
FROM sales"""


def _bigint_counts(sql: str) -> str:
    """DuckDB's ``count_if`` is HUGEINT; Spark's is BIGINT. Cast each call."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(token) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k + 1] + " AS BIGINT)")
        i = k + 1


def oracle_queries() -> dict[str, str]:
    out = analysis_oracles()
    out.update(layer_oracles())
    return {name: _bigint_counts(sql) for name, sql in out.items()}


def analysis_oracles() -> dict[str, str]:
    from .catalog import (
        LATEST_SINCE, LATEST_TOP_N, SKEW_TOP_N, SLICE_RECENT, SLICE_YEAR, SLICE_YEARS,
    )
    years = ", ".join(str(y) for y in SLICE_YEARS)
    return {
        "cells_district_year": with_sales(cells("district, year")),
        "cells_district_type_year": with_sales(cells("district, property_type_name, year")),
        "cells_district_year_approx": with_sales(
            f"SELECT count(*) AS cells, CAST(sum(transactions) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS beyond_bound "
            f"FROM ({cells('district, year')}) c"),
        "cells_quarter": with_sales(cells("year, quarter", None, mean=False)),
        "national_year": with_sales(cells("year", None, mean=False)),
        "region_year": with_sales("SELECT * FROM region_year", REGION_YEAR),
        "trend_growth_district": growth("district"),
        "trend_growth": growth("district, property_type_name"),
        "trend_rolling3": rolling("postcode_area", None),
        "trend_rolling3_gappy": rolling("district, property_type_name", 30),
        "latest_growth_top": latest_growth(LATEST_SINCE, LATEST_TOP_N),
        "cohort_premium": with_sales("SELECT * FROM premium", PREMIUM),
        "cohort_premium_approx": with_sales(
            "SELECT count(*) AS cells, CAST(sum(new_build_transactions) AS BIGINT) AS rows, "
            "CAST(0 AS BIGINT) AS beyond_bound FROM premium", PREMIUM),
        "region_coverage": with_sales(COVERAGE),
        "join_strategy_parity": with_sales(PARITY),
        "dimension_hygiene": with_sales(_hygiene()),
        "group_counts_region": with_sales(
            "SELECT region, count(*) AS rows FROM sales_region GROUP BY region"),
        "group_counts_district_year": with_sales(
            "SELECT district, year, count(*) AS rows FROM sales GROUP BY district, year"),
        "group_counts_area": with_sales(
            "SELECT postcode_area, count(*) AS rows FROM sales_region GROUP BY postcode_area"),
        "headline": with_sales(HEADLINE),
        "skew_top10": skew("postcode_area", SKEW_TOP_N),
        "contract_check": with_sales(
            "SELECT 0 AS missing_columns, count_if(transaction_id IS NULL) AS null_keys, "
            "count(*) AS rows FROM sales_raw"),
        "quality_audit": with_sales(QUALITY),
        "enriched_rows": with_sales(ENRICHED),
        "slice_quarter_years": with_sales(
            f"SELECT * FROM quarter_cells WHERE year IN ({years})", QUARTER),
        "slice_premium_recent": with_sales(
            f"SELECT * FROM premium WHERE year >= {SLICE_RECENT}", PREMIUM),
        "slice_region_year": with_sales(
            f"SELECT * FROM region_year WHERE year = {SLICE_YEAR}", REGION_YEAR),
    }


LAYER_ROWS = """
SELECT transaction_id, price, date_of_transfer, postcode, district, record_status,
       transfer_date, year, month, quarter, postcode_area, is_new_build,
       property_type_name, duration_name, ppd_category_name
FROM sales"""


def _report() -> str:
    since, top_n = 2000, 20
    outputs = {
        "median_price_by_district_year": f"SELECT count(*) FROM ({cells('district, year')}) x",
        "price_growth_by_district": f"SELECT count(*) FROM ({cells('district, year')}) x",
        "rolling_median_by_area": "SELECT count(*) FROM (SELECT DISTINCT postcode_area, year FROM sales) x",
        "new_build_premium": "SELECT count(*) FROM premium",
        "transaction_volume_by_quarter": "SELECT count(*) FROM (SELECT DISTINCT year, quarter FROM sales) x",
        "region_summary": "SELECT count(*) FROM region_year",
        "fastest_growing_districts": (
            f"SELECT least({top_n}, count(DISTINCT district)) FROM "
            f"({cells('district, year', 30, where=f'year >= {since}')}) x WHERE district IS NOT NULL"),
    }
    counts = {
        "ingest_rows_raw": "SELECT count(*) FROM sales_raw", "ingest_rows_clean": "SELECT count(*) FROM sales",
        "ingest_rows_dropped": "SELECT (SELECT count(*) FROM sales_raw) - (SELECT count(*) FROM sales)",
        "ingest_pct_dropped": "SELECT round(100.0::DOUBLE * ((SELECT count(*) FROM sales_raw) - (SELECT count(*) FROM sales)) "
                              "/ (SELECT count(*) FROM sales_raw), 4)",
        **{f"output_{k}": v for k, v in outputs.items()},
        "headline_total_rows": "SELECT count(*) FROM sales",
        "headline_year_min": "SELECT min(year) FROM sales", "headline_year_max": "SELECT max(year) FROM sales",
        "headline_districts": "SELECT count(DISTINCT district) FROM sales",
        "headline_postcode_areas": "SELECT count(DISTINCT postcode_area) FROM sales",
        "headline_median_price_all_time": "SELECT quantile_disc(price, 0.5) FROM sales",
    }
    parts = [f"SELECT '{k}' AS name, CAST(({v}) AS DOUBLE) AS value" for k, v in counts.items()]
    top = ("(SELECT coalesce(postcode_area, 'None') AS area, rows, round(100.0::DOUBLE * rows / sum(rows) OVER (), 3) AS pct "
           "FROM (SELECT postcode_area, count(*) AS rows FROM sales GROUP BY postcode_area) g "
           "ORDER BY rows DESC, postcode_area ASC NULLS FIRST LIMIT 10) t")
    parts += [f"SELECT 'skew_rows_' || area, CAST(rows AS DOUBLE) FROM {top}", f"SELECT 'skew_pct_' || area, pct FROM {top}"]
    return with_sales("\nUNION ALL\n".join(parts), PREMIUM, REGION_YEAR)


#: Types that inference should find: text, whole numbers for the price, timestamps without zone.
_INFERRED = "'string,int,timestamp,string,string,string,string,string,string,string,string,string,string,string,string,string'"


def layer_oracles() -> dict[str, str]:
    from .catalog import YEAR_SLICE
    analysis = analysis_oracles()
    return {
        "layer_roundtrip": with_sales(LAYER_ROWS),
        "year_slice_type_count": with_sales(
            f"SELECT property_type, count(*) AS rows FROM sales WHERE year = {YEAR_SLICE} GROUP BY 1"),
        "year_slice_type_count_csv": with_sales(
            f"SELECT property_type, count(*) AS rows FROM sales_raw "
            f"WHERE year(date_of_transfer) = {YEAR_SLICE} GROUP BY 1"),
        "csv_roundtrip_cells": with_sales(cells("district, year")),
        "csv_inferred_count": with_sales(
            "SELECT count(*) AS rows, CAST((SELECT len(string_split(types, ',')) FROM (SELECT "
            + _INFERRED + " AS types)) AS INTEGER) AS columns, " + _INFERRED + " AS types FROM sales_raw"),
        "footprint": with_sales("SELECT count(*) AS rows, true AS csv_bytes_agree, true AS layer_is_smaller FROM sales_raw"),
        **{f"csv_{k}": analysis[v] for k, v in {
            "quality": "quality_audit", "headline": "headline", "national_year": "national_year", "skew": "skew_top10",
            "volume_quarter": "cells_quarter", "growth_district": "trend_growth_district", "region_year": "region_year",
            "join_parity": "join_strategy_parity", "premium_recent": "slice_premium_recent",
            "volume_years": "slice_quarter_years", "region_one_year": "slice_region_year"}.items()},
        "csv_fastest_growing": latest_growth(2000, 15),
        "csv_summary_premium": with_sales("SELECT * FROM premium", PREMIUM),
        "summary_sink": with_sales(cells("district, year")),
        "sketch_medians": with_sales(
            "SELECT count(*) AS groups, CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS beyond_merged, "
            "CAST(0 AS BIGINT) AS beyond_rescanned FROM (SELECT postcode_area, count(*) AS n FROM sales GROUP BY 1) g"),
        "sketch_distincts": with_sales("SELECT " + ", ".join(
            f"count(DISTINCT {c}) AS {c}_exact, true AS {c}_within" for c in ("district", "postcode_area", "street")) + " FROM sales"),
        "feed_quarantine": with_sales(QUARANTINE),
        "join_bucketed_parity": analysis["join_strategy_parity"],
        "join_skewed_rows": with_sales(PARITY.replace(" AS groups_differing", " AS groups_differing, " + HOT_AREAS)),
        "slice_years_table": with_sales(
            "SELECT year, quarter, count(*) AS rows, CAST(sum(price) AS BIGINT) AS total FROM sales WHERE year IN ("
            "SELECT year FROM (SELECT year, count(*) AS n FROM sales GROUP BY year) y QUALIFY n >= avg(n) OVER ()) GROUP BY year, quarter"),
        "settings_parity": with_sales(
            "SELECT arm, (SELECT count(*) FROM fine) AS rows_a, (SELECT count(*) FROM fine) AS rows_b, "
            "(SELECT count(DISTINCT district) FROM fine) AS groups, CAST(0 AS BIGINT) AS groups_differing "
            "FROM (VALUES (1), (2)) a(arm)",
            "fine AS (SELECT district, year, region FROM sales_region GROUP BY ALL)"),
        "footprint_years": with_sales("SELECT year, count(*) AS rows, true AS has_files, true AS sums_to_layer FROM sales GROUP BY year"),
        "run_report": _report(),
    }
