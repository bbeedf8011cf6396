"""Language ID by Bayesian evidence fusion.

The log posterior of a language is the sum of four pieces of evidence:

- text: naive Bayes over hashed byte trigrams that hold a letter (ASCII lower-cased),
  counted over the whole text; n trigrams weigh as ``n`` up to 50 and
  ``50 (1 + ln(n / 50))`` beyond, as neighbours aren't independent;
- the declared markup language and the address suffix: how often each language's
  rows declare that value, by grouped aggregation over all rows;
- host: its share of each language, smoothed towards its domain's, and that towards
  all rows' (``kappa`` pseudo-rows a level), by grouped aggregation over all rows.

The languages are the values that at least ``least_rows`` (5) rows declare, counted over
all rows, or those given as ``languages``. A value that fewer rows declare has no
profile: its rows are scored like any other, so they go to a known language whose
trigrams explain them, else to "und", and are not accepted there.

Beside the languages stands "und", under which every trigram is as likely: it wins
where no language explains the text. A row is accepted if a language wins with a
posterior of ``least`` or more. Texts without a letter (NULL, empty, digits) are
"und" and rejected. The profiles are fitted on at most ``max_rows`` rows of each
declared language (those of least ``xxhash64(id)``; a documented bound); all else
covers every row. NULL hosts, suffixes and declarations are values like others.
Repeated rows are scored alike and counted each. No rows: no rows.

Tables by host are joined by broadcast behind a check of their size, else by shuffle.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import small, written
from .words import LOWER, column, raw, slices

BITS = 15
LEAST_ROWS = 5
MAX_ROWS = 1_000
KAPPA = 20.0
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True


def trigrams(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every byte trigram that holds a letter."""
    data, offs = raw(arr)
    data = LOWER[data]
    n = max(0, len(data) - 2)
    code = (data[:n].astype(np.uint32) << 16) | (data[1:n + 1].astype(np.uint32) << 8) | data[2:n + 2]
    letter = _LETTER[data]
    ok = letter[:n] | letter[1:n + 1] | letter[2:n + 2]
    size = np.maximum(np.diff(offs), 0)
    rows = np.repeat(np.arange(len(size)), size)[:n]
    ok &= np.repeat(offs[1:], size)[:n] >= np.arange(n) + 3
    place = (code[ok] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    return rows[ok], place.astype(np.int64)


def languages_of(df: DataFrame, declared: str, least_rows: int = LEAST_ROWS) -> tuple[str, ...]:
    """The declared values of ``least_rows`` rows or more, in order (few, so they go to the driver)."""
    found = df.where(F.col(declared) != "").groupBy(F.col(declared).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    return tuple(sorted(r["lang"] for r in found.where(F.col("n") >= least_rows).collect()))


def profiles(df: DataFrame, *, text: str, id: str, declared: str, languages: Sequence[str],
             max_rows: int = MAX_ROWS) -> np.ndarray:
    """Log probability of each trigram place by language (rows) with add-half smoothing."""
    spark = df.sparkSession
    table = np.full((len(languages), 1 << BITS), 0.5)
    if not languages:
        return table
    base = df.select(F.col(id).alias("id"), F.col(declared).alias("lang"))
    picked = None
    for lang in languages:
        own = base.where(F.col("lang") == lang).orderBy(F.xxhash64("id"), "id").limit(max_rows)
        picked = own if picked is None else picked.unionByName(own)
    picked = written(picked.distinct(), "language-sample")        # languages * max_rows rows at most
    work = df.select(F.col(id).alias("id"), F.col(declared).alias("lang"), F.col(text).cast("string").alias("text"))
    work = work.join(F.broadcast(picked), ["id", "lang"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {lang: np.zeros(1 << BITS, np.int64) for lang in languages}
        for b in batches:
            arr = column(b.column(1))
            langs = np.array(b.column(0).to_pylist(), object)
            for lo, hi in slices(arr):
                rows, place = trigrams(arr.slice(lo, hi - lo))
                of = langs[lo:hi][rows]
                for lang in set(langs[lo:hi]):
                    held[lang] += np.bincount(place[of == lang], minlength=1 << BITS)
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])],
                ["lang", "place", "n"])

    rows = (work.mapInArrow(count, "lang string, place int, n long")
            .groupBy("lang", "place").agg(F.sum("n").alias("n")).collect())   # languages * 2**BITS numbers at most
    at = {lang: k for k, lang in enumerate(languages)}
    for r in rows:
        table[at[r["lang"]], r["place"]] += r["n"]
    return np.log(table / table.sum(axis=1, keepdims=True))


def with_text_evidence(df: DataFrame, logp: np.ndarray, *, text: str, name: str = "evidence") -> DataFrame:
    """``df`` with the column ``name``: tempered log likelihood of each language and,
    last, of "und"; NULL for a text without a letter."""
    held = df.sparkSession.sparkContext.broadcast(logp.astype(np.float32))     # languages * 2**BITS floats
    at = df.columns.index(text)
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for b in batches:
            arr = column(b.column(at))
            out = np.zeros((b.num_rows, len(table) + 1))
            seen = np.zeros(b.num_rows, np.int64)
            for lo, hi in slices(arr):
                rows, place = trigrams(arr.slice(lo, hi - lo))
                n = np.bincount(rows, minlength=hi - lo)
                seen[lo:hi] = n
                heavy = np.where(n <= 50, n, 50 * (1 + np.log(np.maximum(n, 50) / 50)))
                for k in range(len(table)):
                    out[lo:hi, k] = np.bincount(rows, table[k][place], hi - lo) / np.maximum(n, 1) * heavy
                out[lo:hi, -1] = -BITS * np.log(2) * heavy
            offs = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * (len(table) + 1))
            found = pa.ListArray.from_arrays(offs, pa.array(out.ravel()), mask=pa.array(seen == 0))
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(columns))] + [found], [*columns, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))]))


def _winner(scores: Column, n: int) -> Column:
    """Place of the largest score (the first of equals), NULL without scores."""
    return F.array_position(scores, F.array_max(scores)).cast("int") - 1


def evidence_tables(seen: DataFrame, n: int, kappa: float = KAPPA) -> dict[str, DataFrame]:
    """From (declared, suffix, domain, host, evidence) of all rows: tables of
    log P(declared | language), log P(suffix | language) and log P(language | host)."""
    rows = seen.where("evidence IS NOT NULL").withColumn("won", _winner(F.col("evidence"), n))
    counts = [F.count(F.when(F.col("won") == k, 1)).alias(f"n{k}") for k in range(n)]
    cells = written(rows.groupBy("declared", "suffix", "domain", "host").agg(*counts), "language-cells")
    sums = [F.sum(f"n{k}").alias(f"n{k}") for k in range(n)]
    got = cells.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in range(n)]).first()      # n numbers
    totals = [float(x) for x in got]
    every = sum(totals)
    overall = [F.lit((t + 1) / (every + n)) for t in totals]
    out = {}
    for name in ("declared", "suffix"):
        found = written(cells.groupBy(name).agg(*sums), f"language-{name}-counts")
        kinds = max(1, found.count())
        like = [F.log((F.col(f"n{k}") + 0.5) / F.lit(t + 0.5 * kinds)) for k, t in enumerate(totals)]
        out[name] = written(found.select(F.col(name).alias("key"), F.array(*like).alias(f"by_{name}")), f"language-{name}")
    size = sum((F.col(f"n{k}") for k in range(1, n)), F.col("n0"))
    domain = cells.groupBy("domain").agg(*sums).select(F.col("domain").alias("of"), *[
        ((F.col(f"n{k}") + kappa * overall[k]) / (size + kappa)).alias(f"d{k}") for k in range(n)])
    host = cells.groupBy("domain", "host").agg(*sums).join(domain, F.col("domain").eqNullSafe(F.col("of")))
    prior = [F.log((F.col(f"n{k}") + kappa * F.col(f"d{k}")) / (size + kappa)) for k in range(n)]
    out["host"] = written(host.select(F.col("host").alias("key"), F.col("domain").alias("key2"),
                                      F.array(*prior).alias("by_host")), "language-host")
    return out


def fuse(seen: DataFrame, tables: dict[str, DataFrame], languages: Sequence[str], least: float = 0.5) -> DataFrame:
    """``seen`` with ``lang_id``, ``confidence`` and ``accepted`` added."""
    keep = seen.columns
    out = seen
    for name in ("declared", "suffix", "host"):
        side = tables[name].withColumnRenamed("key", f"__{name}")
        on = F.col(name).eqNullSafe(F.col(f"__{name}"))
        if name == "host":
            side = side.withColumnRenamed("key2", "__domain")
            on &= F.col("domain").eqNullSafe(F.col("__domain"))
        out = out.join(small(side, 120 + 8 * len(languages)), on, "left").drop(f"__{name}", "__domain")
    total = F.col("evidence")
    for name in ("declared", "suffix", "host"):
        total = F.zip_with(total, F.coalesce(F.col(f"by_{name}"), F.transform("evidence", lambda x: F.lit(0.0))),
                           lambda a, b: a + b)
    out = out.withColumn("__total", total)
    names = F.array(*[F.lit(x) for x in [*languages, "und"]])
    top = F.array_max("__total")
    sure = 1 / F.aggregate(F.col("__total"), F.lit(0.0), lambda s, x: s + F.exp(x - top))
    won = F.coalesce(F.get(names, _winner(F.col("__total"), len(languages) + 1)), F.lit("und"))
    sure = F.when(F.col("evidence").isNull(), F.lit(0.0)).otherwise(sure)
    return out.select(*keep, won.alias("lang_id"), sure.alias("confidence"),
                      ((won != "und") & (sure >= least)).alias("accepted"))


def language_id(df: DataFrame, *, text: str, id: str, declared: Column, suffix: Column, domain: Column, host: Column,
                languages: Sequence[str] | None = None, least_rows: int = LEAST_ROWS, max_rows: int = MAX_ROWS,
                least: float = 0.5, carry: Sequence[str] = (), only_accepted: bool = False) -> DataFrame:
    """One row per row of ``df``: the id, the columns to ``carry``, ``lang_id``, ``confidence``, ``accepted``; or with
    ``only_accepted`` the id and the carried columns, whatever their names, of the accepted rows."""
    keys = {"declared": declared, "suffix": suffix, "domain": domain, "host": host}
    work = df.select(F.struct(F.col(id).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry) if c != text]).alias("own"),
                     *[v.cast("string").alias(k) for k, v in keys.items()], F.col(text).cast("string").alias("text"))
    # own: a struct, so that no carried name can clash (without the text, which goes along once)
    base = work.select(F.col("own.id").alias("id"), "declared", "text")
    languages = languages_of(base, "declared", least_rows) if languages is None else tuple(languages)
    logp = profiles(base, text="text", id="id", declared="declared", languages=languages, max_rows=max_rows)
    narrow = written(with_text_evidence(work.select(F.col("own.id").alias("id"), *keys, "text"), logp, text="text")
                     .drop("text"), "language-evidence")
    tables = evidence_tables(narrow, len(languages) + 1)
    if not carry:
        found = fuse(narrow, tables, languages, least)
        return found.select(F.col("id").alias(id), "lang_id", "confidence", "accepted")
    found = fuse(with_text_evidence(work, logp, text="text"), tables, languages, least)
    carried = [F.col("own.id").alias(id), *[F.col("text" if c == text else f"own.c{i}").alias(c) for i, c in enumerate(carry)]]
    if only_accepted:
        return found.where("accepted").select(*carried)
    return found.select(*carried, "lang_id", "confidence", "accepted")


def primary_subtag(tag: Column) -> Column:
    """A language tag up to its first ``-`` or ``_``, in lower case: ``fil-PH`` is ``fil``, and not ``fi``."""
    return F.lower(F.split(tag, "[-_]")[0])


def of_documents(docs: DataFrame, carry: Sequence[str] = (), **kw) -> DataFrame:
    """Documents: ``lang`` is the declared language and ``source`` the host; they have no address."""
    none = F.lit(None).cast("string")
    return language_id(docs, text="text", id="doc_id", declared=primary_subtag(F.col("lang")), suffix=none,
                       domain=none, host=F.col("source"), carry=carry, **kw)


def of_pages(pages: DataFrame, **kw) -> DataFrame:
    """Pages: language of the html tag, last label of the host, its last two labels, the host."""
    host = F.lower(F.try_parse_url(F.col("url"), F.lit("HOST")))
    work = pages.select(
        "page_id", F.regexp_replace("html", r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", " ").alias("text"),
        F.lower(F.nullif(F.regexp_extract("html", r"(?is)<html[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1), F.lit(""))).alias("declared"),
        host.alias("host"))
    return language_id(work, text="text", id="page_id", declared=F.col("declared"),
                       suffix=F.substring_index("host", ".", -1), domain=F.substring_index("host", ".", -2),
                       host=F.col("host"), **kw)
