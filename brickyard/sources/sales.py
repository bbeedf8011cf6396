"""The feed contract projected from the star-schema test tables.

The test data has no property sales, so each ``lineitem`` row becomes one sale:
its price, ship date, return flag and line status, its order's status and
priority, its customer's nation (→ district, postcode area) and region
(→ county), and its part's type and name. The result carries exactly the 16
feed columns, so every operator runs on it as it would on the real feed.

Join plan, chosen for scale (CBO join reordering is off, so the written order
is the executed order):

1. every table is cut down to what the feed needs before any join: codes are
   decoded, prices floored and supplier numbers folded on the table they come
   from, so a shuffled row holds short values only;
2. customer (its nation as a number) ⋈ orders on custkey: the orders-sized
   shuffle happens *before* the lineitem join;
3. lineitem ⋈ (2) on orderkey, then ⋈ part on partkey: street names join last,
   so no shuffle of sales carries them;
4. ⋈ nation ⋈ region, two fixed-size tables whose texts never cross a shuffle.

The joins of lineitem are shuffled hash joins by hint. Each task builds a hash
table of its share of orders or part and streams the sales past it: no sort of
sales, hence nothing to spill as they grow, and no table built on the driver (at
sf0.1 the planner would broadcast lineitem itself). A hash table holds a share of
the shuffle partitions' number; all that run at once never hold more than the
whole of orders' four short columns. The strategy doesn't change with the tables'
sizes, so neither does the growth of the bytes. The other joins are left to
Catalyst's own size check (``autoBroadcastJoinThreshold``), and AQE re-plans from
the real shuffle sizes at run time. The cleaning predicates on status and price
are pushed below the joins.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import FEED_COLUMNS
from ..functions.features import decode

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# --- fixed values: projection of the star schema onto the feed ---
# postcode area by customer nation key 0..24 ("-" = no postcode)
AREA_BY_NATION = [
    "SW", "M", "LS", "B", "CF", "NE", "L", "BS", "E", "N", "NG", "TD", "EH",
    "ZZ", "-", "OX", "CB", "YO", "SE", "W", "CH", "PL", "PE", "S", "GU",
]
# property type code by the first word of p_type (X = an unknown code)
TYPE_BY_PART_WORD = {"ECONOMY": "D", "PROMO": "S", "LARGE": "T", "MEDIUM": "F",
                     "STANDARD": "O", "SMALL": "X"}
OLD_NEW_BY_RETURNFLAG = {"N": "Y", "A": "N"}          # R → NULL
DURATION_BY_LINESTATUS = {"F": "F", "O": "L"}
STATUS_BY_ORDERSTATUS = {"F": "A", "O": "C", "P": "D"}
CATEGORY_B_PRIORITIES = ("1-URGENT", "2-HIGH")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def area_by_nation() -> dict[str, str]:
    return {str(i): a for i, a in enumerate(AREA_BY_NATION) if a != "-"}


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales in the feed contract (16 columns), before cleaning."""
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_name", "n_regionkey",
        decode(F.col("n_nationkey").cast("string"), area_by_nation()).alias("n_area"))
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).drop("n_regionkey", "r_regionkey")

    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", decode("o_orderstatus", STATUS_BY_ORDERSTATUS).alias("o_status"),
        F.when(F.col("o_orderpriority").isin(*CATEGORY_B_PRIORITIES), "B").otherwise("A").alias("o_category"))
    ords = orders.join(customer, orders.o_custkey == customer.c_custkey).drop("o_custkey", "c_custkey")

    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate",
        F.floor("l_extendedprice").alias("l_price"),
        (F.lit(1) + F.col("l_suppkey") % 9).cast("byte").alias("l_supplier"),
        decode("l_returnflag", OLD_NEW_BY_RETURNFLAG).alias("l_old_new"),
        decode("l_linestatus", DURATION_BY_LINESTATUS).alias("l_duration"))
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", decode(F.substring_index("p_type", " ", 1), TYPE_BY_PART_WORD).alias("p_code"))
    rows = (lineitem.join(ords.hint("shuffle_hash"), lineitem.l_orderkey == ords.o_orderkey).drop("o_orderkey")
                    .join(part.hint("shuffle_hash"), lineitem.l_partkey == part.p_partkey)
                    .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))

    null_str = F.lit(None).cast("string")
    cols = {
        "transaction_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "price": F.col("l_price").cast("int"),
        "date_of_transfer": F.col("l_shipdate").cast("timestamp_ntz"),
        "postcode": F.concat("n_area", F.col("l_supplier").cast("string"), F.lit(" 1AA")),
        "property_type": F.col("p_code"),
        "old_new": F.col("l_old_new"),
        "duration": F.col("l_duration"),
        "paon": null_str,
        "saon": null_str,
        "street": F.col("p_name"),
        "locality": null_str,
        "town_city": F.col("c_mktsegment"),
        "district": F.col("n_name"),
        "county": F.col("r_name"),
        "ppd_category_type": F.col("o_category"),
        "record_status": F.col("o_status"),
    }
    return rows.select(*[cols[c].alias(c) for c in FEED_COLUMNS])
