"""The feed's data contract and its CSV reader / writer.

The contract is declared, never inferred: inference costs a full extra pass
over the file before the job can even plan. Spark drops the non-null flag on
file reads, so "transaction_id is never NULL" is a checked rule
(``check_contract``), not a type promise.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType, StringType, StructField, StructType, TimestampNTZType,
)

from ..functions.codes import FEED_COLUMNS, FEED_TIMESTAMP_FORMAT

QUOTE = '"'

_TYPES = {"price": IntegerType(), "date_of_transfer": TimestampNTZType()}

# The feed has no time zone: the timestamp is wall-clock text, so it is read
# as TIMESTAMP_NTZ and calendar parts never depend on the session zone.
FEED_SCHEMA = StructType([
    StructField(name, _TYPES.get(name, StringType()), nullable=(name != "transaction_id"))
    for name in FEED_COLUMNS
])


def _reader(spark: SparkSession):
    return (spark.read
            .option("header", "false")
            .option("quote", QUOTE)
            .option("timestampNTZFormat", FEED_TIMESTAMP_FORMAT)
            .option("timestampFormat", FEED_TIMESTAMP_FORMAT)
            .option("mode", "PERMISSIVE"))


def read_feed_csv(spark: SparkSession, path: str, *, schema: StructType = FEED_SCHEMA) -> DataFrame:
    """Scan a headerless, double-quoted feed with the declared contract.

    Malformed cells become NULL with the row kept; the cleaning audit counts
    them per rule instead of letting them vanish silently.
    """
    return _reader(spark).schema(schema).csv(path)


def read_feed_csv_inferred(spark: SparkSession, path: str, *,
                           sampling_ratio: float | None = None) -> DataFrame:
    """Same scan with schema inference (columns ``_c0…``); optionally sampled.

    Exists for the inference-cost comparison only; production reads declare.
    """
    r = _reader(spark).option("inferSchema", "true")
    if sampling_ratio is not None:
        r = r.option("samplingRatio", str(sampling_ratio))
    return r.csv(path)


def write_feed_csv(df: DataFrame, path: str) -> None:
    """Write rows in the feed's own layout: headerless, every field quoted."""
    (df.select(*FEED_COLUMNS)
       .write.mode("overwrite")
       .option("header", "false")
       .option("quote", QUOTE)
       .option("quoteAll", "true")
       .option("timestampNTZFormat", FEED_TIMESTAMP_FORMAT)
       .option("timestampFormat", FEED_TIMESTAMP_FORMAT)
       .csv(path))


def check_contract(df: DataFrame, *, key: str = "transaction_id") -> DataFrame:
    """One row: missing contract columns (as a count) and NULL keys.

    The column check is static; the NULL-key count is one aggregate pass.
    """
    missing = [c for c in FEED_COLUMNS if c not in df.columns]
    return df.agg(
        F.lit(len(missing)).alias("missing_columns"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count(F.lit(1)).alias("rows"),
    )
