"""Malformed feed rows told apart from rows with missing cells, and set aside by cause.

A permissive CSV scan turns a cell that can't be parsed into NULL, which the cleaning audit then
counts as missing. ``read_feed_marked`` keeps the raw line of such rows beside them (Spark's
corrupt-record column); ``causes`` reads that line again as text and names what is wrong with it;
``stage`` stores both in one pass over the feed, and ``split`` gives the sound rows, in the contract,
and the quarantine: line and causes, to be read again once the feed is mended.

Causes: ``columns`` (more or fewer cells than the contract), ``price`` and ``date_of_transfer``
(a cell that holds text, but no whole number of its type or no timestamp of the feed's format).
A line may have several. An empty cell is missing, not malformed, and stays with the sound rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.codes import FEED_COLUMNS, FEED_TIMESTAMP_FORMAT
from .contract import FEED_SCHEMA, _reader

RAW = "_line"
CAUSES = ("columns", "price", "date_of_transfer")
_EXTRA = "_beyond"
_TEXT = ", ".join(f"{c} string" for c in [*FEED_COLUMNS, _EXTRA])


def read_feed_marked(spark: SparkSession, path: str, *, raw: str = RAW) -> DataFrame:
    """The feed in the contract, with the raw line of malformed rows in ``raw`` (NULL for sound ones)."""
    schema = StructType([*FEED_SCHEMA.fields, StructField(raw, StringType())])
    return _reader(spark).schema(schema).option("columnNameOfCorruptRecord", raw).csv(path)


def causes(raw: Column) -> Column:
    """Array of causes of a raw line, in the order of ``CAUSES``; empty for a sound line."""
    cells = F.from_csv(raw, _TEXT, {"quote": '"', "mode": "PERMISSIVE"})
    price, date = cells["price"], cells["date_of_transfer"]
    wrong = {
        "columns": cells[FEED_COLUMNS[-1]].isNull() & ~raw.rlike('(,|,"")$') | cells[_EXTRA].isNotNull(),
        "price": F.coalesce(price != "", F.lit(False)) & price.try_cast("int").isNull(),
        "date_of_transfer": F.coalesce(date != "", F.lit(False)) & F.try_to_timestamp(date, F.lit(FEED_TIMESTAMP_FORMAT)).isNull(),
    }
    return F.filter(F.array(*[F.when(wrong[c], F.lit(c)) for c in CAUSES]), lambda c: c.isNotNull())


def stage(marked: DataFrame, path: str, *, raw: str = RAW) -> DataFrame:
    """Parse a marked feed once and store it under ``path``, sound rows and malformed lines in folders of their own,
    the latter with their ``causes``; read back. (All cells are parsed here: over pruned columns Spark would find
    fewer malformed ones.)"""
    out = marked.withColumns({"causes": F.when(F.col(raw).isNotNull(), causes(F.col(raw))), "sound": F.col(raw).isNull()})
    out.write.mode("overwrite").partitionBy("sound").parquet(path)
    return marked.sparkSession.read.schema(out.schema).parquet(path)


def split(staged: DataFrame, *, raw: str = RAW) -> tuple[DataFrame, DataFrame]:
    """(sound rows in the contract, quarantine of ``line`` and ``causes``) of a staged feed."""
    sound = staged.where("sound").select(*FEED_COLUMNS)
    return sound, staged.where("NOT sound").select(F.col(raw).alias("line"), "causes")


def counts_by_cause(staged: DataFrame) -> DataFrame:
    """``cause`` and ``rows``: lines set aside by cause, and sound rows whose price or date is missing."""
    sound, lines = split(staged)
    bad = lines.select(F.explode("causes").alias("cause")).groupBy("cause").agg(F.count(F.lit(1)).alias("rows"))
    gaps = sound.agg(F.count_if(F.col("price").isNull()).alias("price"), F.count_if(F.col("date_of_transfer").isNull()).alias("date"))
    missing = gaps.select(F.explode(F.array(
        F.struct(F.lit("missing price").alias("cause"), F.col("price").alias("rows")),
        F.struct(F.lit("missing date_of_transfer").alias("cause"), F.col("date").alias("rows")))).alias("m")).select("m.*")
    return bad.unionByName(missing)
