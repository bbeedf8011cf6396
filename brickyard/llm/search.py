"""Ranked lexical search: the best documents of every query item, by dense blocked products.

Terms are runs of letters, digits and bytes of other scripts (A-Z lower-cased). The terms
of the items are the vocabulary. One pass over the texts writes postings: a row a document
that holds at least one term, with its length and the numbers and counts of the vocabulary
terms in it, and a row a task with the partial sums behind the weights (documents, terms,
documents holding each vocabulary term). Weights follow from their totals:

    w = floor(1000 * ln((2*N + 2) / (2*df + 1)))            in doubles, the rest in integers
    m = 50 + ((50*n*N) div L)
    score = sum of w * ((1000000000*tf) div (1000*tf + 20*m)) over the item's terms, once each

A second pass multiplies tiles: items by vocabulary (weights, 0 where an item lacks the
term) times vocabulary by documents (impacts, below 2**20), in float64 through BLAS. A
vocabulary tile holds only terms that the document tile has, and ends before the weights of
any item times the greatest impact could sum to 2**53; so every product is an exact integer,
and tiles are added as 64-bit integers. After each tile an item keeps its ``top`` documents
by (score, id): all above the score of the last place, and of those equal to it the least
ids, so ties are decided the same way wherever tiles end. Tasks hand on ``top`` rows an item
at most; these are ranked in two rounds, by salt and then by item.

Items go to the tasks in blocks of ``ITEM_BYTES`` of terms, one block after the other with a
pass each, so what is broadcast has a bound. Vocabulary terms are compared by 64-bit hashes.

NULL texts have no terms; items without terms, and documents without any, are in no result.
Rows that share an item id are one item with all their terms; a NULL item id is an item too.
Each row of the documents is a document of its own, ids may repeat (both rows are ranked) and
NULL ids come last among equal scores. No rows on either side: no rows.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .tables import partitions, written
from .words import KINDS, Words, column, slices

TOP = 50
ITEM_BYTES = 16 << 20                # of terms and their item ids, a block of items
DOCS, ITEMS, TERMS = 512, 512, 2048  # of a tile
EXACT = 1 << 53
IMPACT = 10**6                       # an impact is below: (10**9 tf) div (1000 tf + 20 m), m >= 1
#: Byte classes: letters, digits and bytes of other scripts are terms, all else parts them.
TERM = (KINDS == 1).astype(np.uint8)
_FOUND = [StructField("doc", LongType()), StructField("score", LongType()), StructField("task", IntegerType())]


def _words(arr: pa.Array) -> Words:
    return Words(arr, classes=TERM, lower=True)


def item_terms(items: DataFrame, *, text: str = "text", id: str = "item_id") -> DataFrame:
    """Distinct (item, term) by the term's 64-bit hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arr = column(b.column(1))
            for lo, hi in slices(arr):
                w = _words(arr.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo).take(pa.array(w.rows)), pa.array(w.hashes.view(np.int64))], ["item", "term"])

    work = items.select(F.col(id).alias("item"), F.col(text).cast("string").alias("text"))
    return work.mapInArrow(run, StructType([work.schema["item"], StructField("term", LongType())])).distinct()


def _postings(vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, n, terms, counts) of documents with terms; a last row (NULL n) with the task's
    documents and terms as ``doc`` of ``terms``, and ``counts`` of documents by vocabulary term."""
    terms = vocabulary.value
    docs, total, df = 0, 0, np.zeros(len(terms), np.int64)
    for b in batches:
        arr = column(b.column(1))
        for lo, hi in slices(arr):
            w = _words(arr.slice(lo, hi - lo))
            n = np.diff(w.bounds)
            docs, total = docs + int((n > 0).sum()), total + len(w)
            at = np.minimum(np.searchsorted(terms, w.hashes), len(terms) - 1)
            hit = np.flatnonzero(terms[at] == w.hashes)
            key, tf = np.unique(w.rows[hit] * len(terms) + at[hit], return_counts=True)
            row, term = key // len(terms), key % len(terms)
            df += np.bincount(term, minlength=len(terms))
            some, first = np.unique(row, return_index=True)
            offs = pa.array(np.append(first, len(row)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo).take(pa.array(some)), pa.array(n[some], pa.int64()),
                 pa.ListArray.from_arrays(offs, pa.array(term, pa.int64())), pa.ListArray.from_arrays(offs, pa.array(tf, pa.int64()))],
                ["doc", "n", "terms", "counts"])
    seen = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array([docs], pa.int64()), pa.array([None], pa.int64()), pa.array([[total, *seen.tolist()]], pa.list_(pa.int64())),
         pa.array([[0, *df[seen].tolist()]], pa.list_(pa.int64()))], ["doc", "n", "terms", "counts"])


def _lengths(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """m of documents of n terms: 50 + ((50*n*N) div L), exact beyond 64 bits too."""
    if len(n) and int(n.max()) * 50 * docs < 1 << 63:
        return 50 + (50 * docs * n) // total
    return np.array([50 + 50 * docs * int(x) // total for x in n], np.int64)


def vocabulary_tiles(weights: np.ndarray, most: int = TERMS, exact: int = EXACT) -> list[slice]:
    """Column ranges of a weight matrix (items by terms): at most ``most`` terms each, and no item's
    weights times the greatest impact reach ``exact`` (those of a single term never do)."""
    n, cuts = weights.shape[1], [0]
    while cuts[-1] < n:
        sums = np.cumsum(weights[:, cuts[-1]:cuts[-1] + most], axis=1).max(axis=0, initial=0.0)
        cuts.append(cuts[-1] + max(1, int(np.searchsorted(sums * IMPACT, exact, "left"))))
    return [slice(x, y) for x, y in zip(cuts, cuts[1:], strict=False)]


class Best:
    """The ``top`` documents of each item so far: by score, descending, NULL ids last, then by id."""

    def __init__(self, top: int):
        self.top = top
        self.item, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.null, self.doc = np.zeros(0, bool), np.zeros(0, np.int64)

    def last(self, items: int) -> np.ndarray:
        """Score that a document must reach to matter, by item."""
        least = np.ones(items, np.int64)
        if len(self.item):
            first = np.flatnonzero(np.append(True, np.diff(self.item) != 0))
            size = np.diff(np.append(first, len(self.item)))
            full = size == self.top
            least[self.item[first[full]]] = self.score[first[full] + self.top - 1]
        return least

    def add(self, item: np.ndarray, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        null, doc = np.concatenate([self.null, null]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, null, -score, item))
        first = np.flatnonzero(np.append(True, np.diff(item[order]) != 0)) if len(order) else np.zeros(0, np.int64)
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        order = order[place < self.top]
        self.item, self.score, self.null, self.doc = item[order], score[order], null[order], doc[order]


def _score(query, docs: int, total: int, top: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best documents of each item over a task's postings: (item, doc, score, task)."""
    item_of, term_of, weight_of, names = query.value       # entries of the weight matrix, by term
    items = len(names)
    best = Best(top)
    for b in batches:
        for lo in range(0, b.num_rows, DOCS):
            t = b.slice(lo, DOCS)
            many = np.diff(t.column(2).offsets.to_numpy())
            term, tf = (t.column(k).flatten().to_numpy(zero_copy_only=False) for k in (2, 3))
            row = np.repeat(np.arange(t.num_rows), many)
            m = _lengths(t.column(1).to_numpy(zero_copy_only=False), docs, total)
            impact = (10**9 * tf) // (1000 * tf + 20 * m[row])
            present, place = np.unique(term, return_inverse=True)
            a, z = np.searchsorted(term_of, present), np.searchsorted(term_of, present, "right")
            of = np.repeat(np.arange(len(present)), z - a)
            entry = np.repeat(a - (np.cumsum(z - a) - (z - a)), z - a) + np.arange(len(of))
            dense = np.zeros((len(present), t.num_rows))
            dense[place, row] = impact
            ids = t.column(0)
            null = ~np.array(ids.is_valid())
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
            least = best.last(items)
            for first in range(0, items, ITEMS):
                size = min(ITEMS, items - first)
                own = (item_of[entry] >= first) & (item_of[entry] < first + size)
                weights = np.zeros((size, len(present)))
                weights[item_of[entry[own]] - first, of[own]] = weight_of[entry[own]]
                score = np.zeros((size, t.num_rows), np.int64)
                for tile in vocabulary_tiles(weights):
                    score += (weights[:, tile] @ dense[tile]).astype(np.int64)
                i, d = np.nonzero(score >= least[first:first + size, None])
                if len(i):
                    best.add(i + first, score[i, d], null[d], doc[d])
    task = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays(
        [names.take(pa.array(best.item)), pa.array(best.doc, pa.int64(), mask=best.null), pa.array(best.score),
         pa.array(np.full(len(best.item), task), pa.int32())], ["item", "doc", "score", "task"])


def _search_block(work: DataFrame, block: list, item_field: StructField, top: int) -> DataFrame:
    """(item, doc, score, rank) of one block of items, given as rows (item, term)."""
    spark = work.sparkSession
    names = sorted({r["item"] for r in block}, key=lambda x: (x is not None, x))
    number = {x: k for k, x in enumerate(names)}
    vocabulary, term = np.unique(np.array([r["term"] for r in block], np.int64).view(np.uint64), return_inverse=True)
    order = np.argsort(term, kind="stable")
    term, item = term[order], np.array([number[r["item"]] for r in block], np.int64)[order]

    sent = spark.sparkContext.broadcast(vocabulary)
    postings = written(work.mapInArrow(lambda batches: _postings(sent, batches),
                                       "doc long, n long, terms array<long>, counts array<long>"), "search-postings")
    stats = postings.where("n IS NULL")
    sums = stats.agg(F.sum("doc").alias("docs"), F.sum(F.col("terms")[0]).alias("total")).first()
    docs, total = sums["docs"] or 0, sums["total"] or 0
    df = np.zeros(len(vocabulary), np.int64)               # a row a vocabulary term reaches the driver
    by_term = stats.select(F.explode(F.expr(
        "map_from_arrays(slice(terms, 2, size(terms)), slice(counts, 2, size(counts)))")).alias("term", "df"))
    for r in by_term.groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    query = spark.sparkContext.broadcast((item, term, weight[term], pa.array(names, to_arrow_type(item_field.dataType))))
    found = postings.where("n IS NOT NULL").mapInArrow(
        lambda batches: _score(query, docs, max(total, 1), top, batches),
        StructType([StructField("item", item_field.dataType), *_FOUND]))
    by = [F.desc("score"), F.asc_nulls_last("doc")]
    salt = F.pmod("task", F.lit(max(1, math.isqrt(partitions(spark)))))
    first = found.withColumn("salt", salt).withColumn(
        "place", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*by))).where(F.col("place") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by))).where(F.col("rank") <= top)


def search(documents: DataFrame, items: DataFrame, *, top: int = TOP, text: str = "text", id: str = "doc_id",
           item_text: str = "text", item_id: str = "item_id", block_bytes: int = ITEM_BYTES) -> DataFrame:
    """The item id, ``rank`` (int, from 1), the document id (long) and ``score`` (long) of the ``top`` documents of each item."""
    work = documents.select(F.col(id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    terms = written(item_terms(items, text=item_text, id=item_id), "search-terms")
    width = F.coalesce(F.octet_length(F.col("item").cast("string")), F.lit(0)) + 32
    size = terms.agg(F.sum(width)).first()[0] or 0
    many = -(-size // block_bytes)
    block = F.pmod(F.xxhash64("item"), F.lit(max(many, 1)))
    out = documents.sparkSession.createDataFrame(
        [], StructType([StructField("item", terms.schema["item"].dataType), StructField("rank", IntegerType()),
                        StructField("doc", LongType()), StructField("score", LongType())]))
    for k in range(many):
        rows = terms.where(block == k).collect()           # one block of items: about block_bytes
        if rows:
            out = out.unionByName(_search_block(work, rows, terms.schema["item"], top).select("item", "rank", "doc", "score"))
    return out.withColumnsRenamed({"item": item_id, "doc": id})


ORACLE = """
WITH terms AS (SELECT doc_id, row, unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
               FROM (SELECT doc_id, row_number() OVER () AS row,
                            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
lengths AS (SELECT row, any_value(doc_id) AS doc_id, count(*) AS n FROM terms GROUP BY row),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM lengths),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
tf AS (SELECT row, term, count(*)::BIGINT AS tf FROM terms WHERE term IN (SELECT term FROM wanted) GROUP BY row, term),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM tf, totals GROUP BY term),
impacts AS (SELECT t.row, t.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))) AS part
            FROM tf t JOIN lengths USING (row) JOIN weights USING (term), totals),
scores AS (SELECT item_id, row, sum(part)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY item_id, row)
SELECT item_id, rank, doc_id, score FROM (
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
    FROM scores JOIN lengths USING (row) WHERE score > 0) WHERE rank <= 50
"""
