"""N-gram Jaccard join as a blocked sparse matrix product.

A document's set is its distinct 5-word shingles (words ``[^\\x20\\x09-\\x0D]+`` after
lower-casing A-Z; a document of fewer words has its whole sequence as one; one without
words has none and links with nothing). Two documents link when
``100 * |intersection| >= 80 * |union|``. Documents with equal sets are one row of the
incidence matrix from the start, known by the set's hash and linked as a matter of course.

The product of the document by n-gram incidence with its transpose counts overlaps.
Columns are dealt into hash blocks; only these entries are needed:

1. Order. Shingles that many documents share come last (a list of the commonest,
   counted over all tasks by hash block; its length bounds what is broadcast, and it
   decides the order only). A pair that links shares a shingle among the first
   ``n - ceil(0.8 n) + 1`` of both sets, whatever the order is.
2. Blocks. Each block's task holds its columns' entries. Columns of up to ``SHORT``
   documents are multiplied out and overlap counts of pairs accumulated; longer ones
   are passed on as entries. Columns of the commonest shingles are split by document
   beforehand, so that no block grows with one column.
3. Bounds. A pair stays if its sizes are within 80 % and its accumulated count, with
   all that could lie behind the prefixes, still reaches the overlap that sizes ask for,
   and if its parity bitmaps allow it: a set's bitmap holds, for each of ``MAP`` * 64
   places, whether an odd number of its shingles fall there, so bitmaps differ in at
   most as many places as the sets differ in shingles. Both bounds are exact: no pair
   that links is lost. Sets too large for the bitmap are left to the first one.
4. Links. In a first round each document is verified against its likeliest partner
   and, in long columns, against the column's leader of its size (the one with the most
   entries in long columns, so the least of its own): one or two pairs a document, however large a group of near copies is. Components follow. In the second
   round only pairs of different components are left, in long columns too (columns
   inside one component go at once); all that pass the bounds are verified. So no
   candidate is dropped, and pairs inside a group are never all made.

Verification counts the whole sets' intersection; only sets of pairs that came so far
are read again and shuffled, once a round. Sets are 64-bit hashes; equal hashes
are taken as equal shingles. NULL text is empty. NULL ids never become a component's
id unless it has no other. Rows that repeat an id are documents of their own. No rows:
no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import small, written
from .words import Words, column, mix, shingles, slices

N = 5
OFTEN = 4                        # documents from which a shingle may count as common
COMMON = 200_000                 # commonest shingles that go last: at most 3.2 MB
SHORT = 12                       # documents of a column that is multiplied out in its block
SPLIT = 20_000                   # counted documents of a column from which it is split
COUNTED = 1_000_000              # shingles that a task counts at once
FLUSH = 500_000                  # entries that a task holds at once
MAP = 8                          # 64-bit words of a set's parity bitmap
_STEP = np.log(1.05)


def set_hash(values: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(values).sum() + np.uint64(len(values))], np.uint64)).view(np.int64)[0])


def sets_of(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[list, list[np.ndarray], list[int]]]:
    """Per slice of rows: ids, sorted sets, set hashes."""
    for b in batches:
        arr, ids = column(b.column(1)), b.column(0).to_pylist()
        for lo, hi in slices(arr):
            sets = shingles(Words(arr.slice(lo, hi - lo), lower=True), n)
            yield ids[lo:hi], sets, [set_hash(s) if len(s) else 0 for s in sets]


_MAPS = [f"m{k}" for k in range(MAP)]
_DOC = "id long, sig long, n int, " + ", ".join(f"{m} long" for m in _MAPS)


def parity(values: np.ndarray) -> np.ndarray:
    """A set's parity bitmap in ``MAP`` words."""
    odd = np.bincount((values % np.uint64(64 * MAP)).astype(np.int64), minlength=64 * MAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _documents(n: int):
    """A row for each document."""

    def run(batches):
        for ids, sets, sigs in sets_of(batches, n):
            maps = np.array([parity(s) for s in sets]).T
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sigs, pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                                              *[pa.array(m, pa.int64()) for m in maps]], ["id", "sig", "n", *_MAPS])

    return run


def _block(values: np.ndarray, bits: int) -> np.ndarray:
    return (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)


def _key(values: np.ndarray, bits: int) -> np.ndarray:
    """A shingle's block and the 32 bits behind it: what common shingles are known by."""
    return values >> np.uint64(32 - bits)


def _counts(n: int, bits: int):
    """Shingles by block and how many of a task's sets hold them, each as 32 bits, packed."""

    def flush(held):
        keys, times = np.unique(_key(np.concatenate(held), bits), return_counts=True)
        names, starts = np.unique(keys >> np.uint64(32), return_index=True)
        ends = np.append(starts[1:], len(keys))
        cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), cut(keys.astype(np.uint32)), cut(times.astype(np.uint32))],
                                          ["block", "keys", "times"])

    def run(batches):
        seen, held, total = set(), [], 0
        for _, sets, sigs in sets_of(batches, n):
            for values, sig in zip(sets, sigs, strict=True):
                if len(values) and sig not in seen:
                    seen.add(sig)
                    held.append(values)
                    total += len(values)
            if total >= COUNTED:
                yield flush(held)
                held, total = [], 0
        if total:
            yield flush(held)

    return run


def _sum_counts(least: int):
    """A block's shingles that ``least`` sets hold or more (a set counts once for each task that has it)."""

    def run(key, table):
        join = lambda c: np.concatenate([np.frombuffer(x, np.uint32) for x in table[c].to_pylist()])
        keys, times = join("keys"), join("times")
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        total = np.add.reduceat(times[order].astype(np.int64), starts)
        many = total >= least
        return pa.table({"key": (np.int64(key[0].as_py()) << 32) + keys[starts[many]].astype(np.int64), "times": total[many]})

    return run


def _commonest(counted: DataFrame, most: int, bits: int) -> DataFrame:
    """About the ``most`` rows that are counted most often: whole counts from the highest
    down, and of the last one the share of the hashes for which there is room."""
    levels = counted.groupBy("times").agg(F.count(F.lit(1)).alias("rows")).collect()
    room = most
    for times, rows in sorted(levels, reverse=True):
        if rows > room:
            below = (room << 32 + bits) // rows
            return counted.where((F.col("times") > times) | ((F.col("times") == times) & (F.col("key") < below)))
        room -= rows
    return counted


def size_code(n):
    """Size on a log scale of 5 % steps, in a byte."""
    return np.minimum(np.round(np.log(np.maximum(n, 1)) / _STEP), 255).astype(np.uint8)


def prefix(values: np.ndarray, common: np.ndarray, times: np.ndarray, percent: int, bits: int) -> np.ndarray:
    """The first ``n - ceil(percent n / 100) + 1`` of a set, commonest shingles last."""
    n = len(values)
    most = n - -(-percent * n // 100) + 1
    if len(common):
        keys = _key(values, bits)
        at = np.minimum(np.searchsorted(common, keys), len(common) - 1)
        count = np.where(common[at] == keys, times[at], 0)
        if count.any():
            return values[np.lexsort((values, count))[:most]]
    return values[:most]


def _entries(n: int, percent: int, bits: int, common: np.ndarray, times: np.ndarray, split_at: int):
    """Prefix entries by block: column remainder, set hash and size code, packed."""

    def flush(values, sigs, codes):
        values, sigs, codes = np.concatenate(values), np.concatenate(sigs), np.concatenate(codes)
        block = _block(values, bits)
        if len(common):                                  # a very long column: split by document
            keys = _key(values, bits)
            at = np.minimum(np.searchsorted(common, keys), len(common) - 1)
            ways = np.where(common[at] == keys, times[at] // split_at, 0)
            split = np.flatnonzero(ways)
            block[split] = (block[split] + (sigs[split].view(np.uint64) % (ways[split] + 1).astype(np.uint64)).astype(np.int64)) % (1 << bits)
        order = np.argsort(block, kind="stable")
        names, starts = np.unique(block[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        cut = lambda x: pa.array([x[order[a:b]].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), cut(values), cut(sigs), cut(codes)],
                                          ["block", "cols", "sigs", "codes"])

    def run(batches):
        seen, values, sigs, codes, total = set(), [], [], [], 0
        for _, sets, found in sets_of(batches, n):
            for own, sig in zip(sets, found, strict=True):
                if not len(own) or sig in seen:
                    continue
                seen.add(sig)
                first = prefix(own, common, times, percent, bits)
                values.append(first)
                sigs.append(np.full(len(first), sig, np.int64))
                codes.append(np.full(len(first), size_code(len(own)), np.uint8))
                total += len(first)
            if total >= FLUSH:
                yield flush(values, sigs, codes)
                values, sigs, codes, total = [], [], [], 0
        if total:
            yield flush(values, sigs, codes)

    return run


_CELL = pa.schema([("col", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int32())])


def _multiply(percent: int, short: int, bits: int, apart: np.ndarray):
    """A block's part of the product: overlap counts by pair; entries of long columns (b
    NULL), to which the columns with a key in ``apart`` belong, as other blocks have entries of theirs."""
    slack = np.log(100 / percent) / _STEP + 1

    def run(key, table):
        join = lambda c, kind: np.concatenate([np.zeros(0, kind), *[np.frombuffer(x, kind) for x in table[c].to_pylist()]])
        cols, sigs, codes = join("cols", np.uint64), join("sigs", np.int64), join("codes", np.uint8).astype(np.int64)
        order = np.lexsort((sigs, cols))
        cols, sigs, codes = cols[order], sigs[order], codes[order]
        new = np.ones(len(cols), bool)
        new[1:] = (cols[1:] != cols[:-1]) | (sigs[1:] != sigs[:-1])
        cols, sigs, codes = cols[new], sigs[new], codes[new]
        first = np.ones(len(cols), bool)
        first[1:] = cols[1:] != cols[:-1]
        starts = np.flatnonzero(first)
        size = np.diff(np.append(starts, len(cols)))
        keys = _key(cols[starts], bits)
        place = np.minimum(np.searchsorted(apart, keys), max(0, len(apart) - 1))
        size = np.where(apart[place] == keys, np.iinfo(np.int64).max, size) if len(apart) else size
        lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(2, short + 1):
            own = starts[size == k]
            if len(own):
                i, j = np.triu_indices(k, 1)
                a, b = (own[:, None] + i).ravel(), (own[:, None] + j).ravel()
                near = np.abs(codes[a] - codes[b]) <= slack
                lefts.append(a[near])
                rights.append(b[near])
        a, b = sigs[np.concatenate(lefts)], sigs[np.concatenate(rights)]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(a)))
        long = np.repeat(size > short, np.diff(np.append(starts, len(cols))))
        pairs, rest = len(at), int(long.sum())
        return pa.table({"col": pa.array(np.concatenate([np.zeros(pairs, np.int64), cols[long].view(np.int64)])),
                         "a": pa.array(np.concatenate([a[at], sigs[long]])),
                         "b": pa.array(np.concatenate([b[at], np.zeros(rest, np.int64)]), mask=np.arange(pairs + rest) >= pairs),
                         "c": pa.array(np.concatenate([count, np.ones(rest, np.int64)]).astype(np.int32))}, _CELL)

    return run


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _reaches(count: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether ``count`` shared prefix shingles, with all behind the prefixes, can be enough:
    shared shingles behind both prefixes number at most ``ceil(t n) - 1`` of the larger set."""
    behind = F.floor((percent * F.greatest(a, b) + 99) / 100) - 1
    return (100 + percent) * (count + behind) >= percent * (a + b)


def _alike(a: str, b: str, percent: int) -> Column:
    """Whether the bitmaps of ``a`` and ``b`` differ in no more places than linked sets of
    their sizes may: ``|a| + |b| - 2 overlap``, with the least overlap that links."""
    differ = sum((F.bit_count(F.col(f"{m}{a}").bitwiseXOR(F.col(f"{m}{b}"))) for m in _MAPS[1:]),
                 F.bit_count(F.col(f"m0{a}").bitwiseXOR(F.col(f"m0{b}"))))
    return (100 + percent) * differ <= (100 - percent) * (F.col(f"n{a}").cast("long") + F.col(f"n{b}"))


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, by the intersection of whole sets."""
    joined = (pairs.join(sets.select(F.col("sig").alias("a"), F.col("values").alias("va")), "a")
              .join(sets.select(F.col("sig").alias("b"), F.col("values").alias("vb")), "b").select("a", "b", "va", "vb"))

    def run(batches):
        for t in batches:
            keep = []
            for x, y in zip(t.column(2), t.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield t.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def jaccard_components(df: DataFrame, *, text: str = "text", id: str = "doc_id", n: int = N, percent: int = 80,
                       common: int = COMMON, often: int = OFTEN, short: int = SHORT, split_at: int = SPLIT) -> DataFrame:
    """One row per row of ``df``: the id, ``n_shingles`` and ``component_id``."""
    work = df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    spark = df.sparkSession
    table = written(work.mapInArrow(_documents(n), _DOC), "jaccard-documents")
    docs = table.select("id", "sig", "n")
    sigs = written(table.where("n > 0").groupBy("sig").agg(
        F.min("id").alias("rep"), F.max("n").alias("n"), *[F.max(m).alias(m) for m in _MAPS]), "jaccard-sets")
    bits = min(16, max(0, (sigs.count() // 1024)).bit_length())

    counted = written(work.mapInArrow(_counts(n, bits), "block int, keys binary, times binary").groupBy("block")
                      .applyInArrow(_sum_counts(often), "key long, times long"), "jaccard-common")
    found = _commonest(counted, common, bits).toArrow()                       # pairs of numbers
    keys, times = found["key"].to_numpy().astype(np.uint64), found["times"].to_numpy().astype(np.int64)
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    held = spark.sparkContext.broadcast((keys, times))
    apart = keys[times >= split_at]

    def entries(batches):
        yield from _entries(n, percent, bits, *held.value, split_at)(batches)

    cells = written(work.mapInArrow(entries, "block int, cols binary, sigs binary, codes binary").groupBy("block")
                    .applyInArrow(_multiply(percent, short, bits, apart), "col long, a long, b long, c int"), "jaccard-cells")
    long = cells.where("b IS NULL").select("col", F.col("a").alias("sig"))
    entries_of = long.groupBy("sig").agg(F.count(F.lit(1)).alias("long"))
    known = written(sigs.join(entries_of, "sig", "left").select("sig", "rep", "n", F.coalesce("long", F.lit(0)).alias("long"), *_MAPS),
                    "jaccard-known")
    side = lambda x: known.select(F.col("sig").alias(x), F.col("n").alias(f"n{x}"), F.col("long").alias(f"l{x}"),
                                  *[F.col(m).alias(f"{m}{x}") for m in _MAPS])
    counts = cells.where("b IS NOT NULL").groupBy("a", "b").agg(F.sum("c").alias("c"))
    pairs = written(
        counts.join(side("a"), "a").join(side("b"), "b").where(_sizes_fit(F.col("na"), F.col("nb"), percent))
        .where(_reaches(F.col("c") + F.least("la", "lb"), F.col("na"), F.col("nb"), percent) & _alike("a", "b", percent))
        .select("a", "b", "c"), "jaccard-pairs")

    # first round: the likeliest partner, and the leader of each long column by size
    ways = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "c").unionByName(
        pairs.select(F.col("b").alias("x"), F.col("a").alias("y"), "c"))
    likeliest = ways.groupBy("x").agg(F.max(F.struct("c", "y")).alias("m")).select("x", F.col("m.y").alias("y"))
    sized = written(long.join(known.select("sig", "n", "long"), "sig").withColumn(
        "band", F.floor(F.log("n") / F.lit(float(_STEP)) / 4).cast("int")), "jaccard-long")
    leaders = sized.groupBy("col", "band").agg(F.max(F.struct("long", "sig", "n")).alias("m")).select(
        "col", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"), F.col("m.sig").alias("y"), F.col("m.n").alias("m"))
    led = (sized.join(leaders, ["col", "band"]).where((F.col("sig") != F.col("y")) & _sizes_fit(F.col("n"), F.col("m"), percent))
           .groupBy(F.col("sig").alias("x"), "y", "n", "m").agg(F.count(F.lit(1)).alias("c"))
           .where(_reaches(F.col("c"), F.col("n"), F.col("m"), percent)).select("x", "y", "c")
           .join(side("x"), "x").join(side("y"), "y").where(_alike("x", "y", percent))
           .groupBy("x").agg(F.max(F.struct("c", "y")).alias("m")).select("x", F.col("m.y").alias("y")))
    tried = written(likeliest.unionByName(led).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
                    "jaccard-tried")

    def sets_for(chosen: DataFrame) -> DataFrame:
        """The whole sets that pairs are made of; only texts of the documents that stand for them are read by Python."""
        needed = written(chosen.select(F.explode(F.array("a", "b")).alias("sig")).distinct().join(known.select("sig", "rep"), "sig"),
                         "jaccard-needed")
        own = work.join(small(needed.select(F.col("rep").alias("_rep")), 16), F.col("id").eqNullSafe(F.col("_rep")), "left_semi")
        found = own.mapInArrow(whole, "id long, sig long, values binary").join(small(needed, 24), "sig")
        return written(found.where(F.col("id").eqNullSafe(F.col("rep"))).select("sig", "values"), "jaccard-values")

    def whole(batches):
        seen = set()
        for ids, sets, found in sets_of(batches, n):
            new = []
            for i, key in enumerate(zip(ids, found, strict=True)):       # (rows may repeat an id)
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in new], pa.int64()), pa.array([found[i] for i in new], pa.int64()),
                 pa.array([sets[i].tobytes() for i in new], pa.binary())], ["id", "sig", "values"])

    links = written(_verify(tried, sets_for(tried), percent), "jaccard-links")
    labels = components(links)

    # second round: what lies between components
    label = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}"))
    apart = F.coalesce("label_a", "a") != F.coalesce("label_b", "b")
    short = pairs.join(label("a"), "a", "left").join(label("b"), "b", "left").where(apart).select("a", "b", "c")
    of = sized.join(labels.withColumnRenamed("node", "sig"), "sig", "left").select("col", "sig", "n", "long", F.coalesce("label", "sig").alias("label"))
    mixed = of.groupBy("col").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("col")
    of = written(of.join(mixed, "col").join(known.select("sig", *_MAPS), "sig"), "jaccard-mixed")
    one, two = (of.select("col", F.col("sig").alias(x), F.col("n").alias(f"n{x}"), F.col("long").alias(f"l{x}"),
                          F.col("label").alias(f"label_{x}"), *[F.col(m).alias(f"{m}{x}") for m in _MAPS]) for x in "ab")
    # (a pair that shares a short column too is among ``pairs``, where long columns are allowed for)
    crossed = (one.join(two, (one["col"] == two["col"]) & (F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b"))
                        & _sizes_fit(F.col("na"), F.col("nb"), percent)
                        & _reaches(F.least("la", "lb"), F.col("na"), F.col("nb"), percent) & _alike("a", "b", percent))
               .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("c"))
               .where(_reaches(F.col("c"), F.col("na"), F.col("nb"), percent)).select("a", "b", "c"))
    rest = written(short.unionByName(crossed).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "jaccard-rest")
    if rest.limit(1).count():
        more = written(_verify(rest, sets_for(rest), percent), "jaccard-links")
        if more.limit(1).count():
            labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))

    groups = sigs.join(labels.withColumnRenamed("node", "sig"), "sig", "left").select(
        "sig", "rep", F.coalesce("label", "sig").alias("label"))
    least = groups.groupBy("label").agg(F.min("rep").alias("component"))
    named = groups.join(least, "label").select("sig", "component")
    out = docs.join(named.where("sig <> 0"), "sig", "left")
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, md5(array_to_string(ws[s:s+4], ' ')) AS g
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS s FROM w WHERE len(ws) > 0))),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
         WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.doc_id, b FROM reach JOIN link ON link.a = other)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS INTEGER) AS n_shingles, min(other) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN reach ON reach.doc_id = w.doc_id GROUP BY w.doc_id, n.n
"""
