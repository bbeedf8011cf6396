"""Document fingerprints from prefix polynomial hashes.

``Prefix`` holds, for each of two primes below 2**31, the modular prefix array
``S[i] = sum of c[j] * B**j for j < i`` over a text's code points. Any two spans, of
one text or of two, are compared in constant time by the difference of two prefixes,
brought to a common power; a binary search over spans gives the longest common
extension of two places, forwards or backwards.

The fingerprint of a text is its length and both hashes of the whole. The likeness of
two fingerprints is 2 m / (n1 + n2), with m the code points of common spans found in
order: the common prefix and suffix by longest common extension, and between them
blocks of ``BLOCK`` code points of one text, looked up among all windows of the
other and extended as far as they go. It is 1 for equal texts (two empty ones, too).

``fingerprints`` compares each text with an edited one (its last half replaced by as
much of the next document's beginning) and with the next document, in ascending order
of id, the first one following the last. Documents are dealt into ranges of ids of
about equal counts and sorted; a range ends with a copy of the first document of the
next, so no window runs over all rows. Ties (a repeated id) are ordered by the
text's hash and the text; NULL ids come last; NULL text is empty. A single document
follows itself. No rows: no rows. Texts are compared whole, two at a time.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import blocks, range_bounds, range_of

PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
BLOCK = 32
_POWERS = [np.ones(1, np.uint64) for _ in PRIMES]


def _powers(k: int, n: int) -> np.ndarray:
    """B**0 .. B**n modulo the k-th prime, doubled as needed and kept for the task."""
    got, p = _POWERS[k], np.uint64(PRIMES[k])
    while len(got) <= n:
        step = got[-1] * np.uint64(BASES[k]) % p
        got = np.concatenate([got, got * step % p])
    _POWERS[k] = got
    return got


class Prefix:
    """Prefix arrays of a text."""

    def __init__(self, text: str):
        self.codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        self.n = len(self.codes)
        self.sums = []
        for k, p in enumerate(PRIMES):
            terms = (self.codes + np.uint64(1)) * _powers(k, self.n)[:self.n] % np.uint64(p)
            self.sums.append(np.concatenate([[np.uint64(0)], np.cumsum(terms) % np.uint64(p)]))

    def spans(self, start, size, top: int) -> np.ndarray:
        """Hashes of spans, comparable with those of any text of up to ``top`` code points."""
        start = np.asarray(start, np.int64)
        out = np.zeros(start.shape, np.uint64)
        for k, p in enumerate(PRIMES):
            p = np.uint64(p)
            part = (self.sums[k][start + size] + p - self.sums[k][start]) % p
            out = (out << np.uint64(32)) | (part * _powers(k, top)[top - start] % p)
        return out

    def same(self, i: int, other: Prefix, j: int, size: int) -> bool:
        """Whether two spans are equal: both hashes, with the powers crossed over."""
        for k, p in enumerate(PRIMES):
            a, b, powers = self.sums[k], other.sums[k], _powers(k, max(i, j))
            left = (int(a[i + size]) - int(a[i])) * int(powers[j])
            right = (int(b[j + size]) - int(b[j])) * int(powers[i])
            if (left - right) % p:
                return False
        return True

    def extension(self, i: int, other: Prefix, j: int, back: bool = False) -> int:
        """Longest common extension from the places i and j, forwards or backwards."""
        low, high = 0, min(i, j) if back else min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            equal = self.same(i - mid, other, j - mid, mid) if back else self.same(i, other, j, mid)
            low, high = (mid, high) if equal else (low, mid - 1)
        return low

    def fingerprint(self) -> str:
        return f"{self.n:x}-" + "".join(f"{int(s[-1]):08x}" for s in self.sums)

    def likeness(self, other: Prefix) -> float:
        if self.n + other.n == 0:
            return 1.0
        head = self.extension(0, other, 0)
        if head == self.n == other.n:
            return 1.0
        room = min(self.n, other.n) - head
        tail = min(room, self.extension(self.n, other, other.n, back=True))
        found = head + tail + self._between(other, head, self.n - tail, other.n - tail)
        return 2 * found / (self.n + other.n)

    def _between(self, other: Prefix, start: int, end: int, other_end: int) -> int:
        """Code points of common spans within [start, end) and [start, other_end), in order."""
        if end - start < BLOCK or other_end - start < BLOCK:
            return 0
        top = max(self.n, other.n)
        marks = np.arange(start, end - BLOCK + 1, BLOCK)
        windows = other.spans(np.arange(start, other_end - BLOCK + 1), BLOCK, top)
        order = np.argsort(windows, kind="stable")
        hashes = self.spans(marks, BLOCK, top)
        keys = windows[order]
        at = np.searchsorted(keys, hashes)
        hit = keys[np.minimum(at, len(order) - 1)] == hashes
        found, free, other_free = 0, start, start
        for mark, a in zip(marks[hit].tolist(), at[hit].tolist(), strict=True):
            if mark < free:
                continue
            run = order[a:np.searchsorted(keys, keys[a], "right")]        # ascending places
            k = int(np.searchsorted(run, other_free - start))
            if k == len(run):
                continue
            place = start + int(run[k])
            back = min(self.extension(mark, other, place, back=True), mark - free, place - other_free)
            size = back + min(self.extension(mark, other, place), end - mark, other_end - place)
            found, free, other_free = found + size, mark - back + size, place - back + size
        return found


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


SCHEMA = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_FIELDS = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (range, late): each with the one after it in its range."""
    held = first = None                                  # (range, id, text, Prefix)

    def row(own, after):
        changed = edited(own[2], after[2])
        one, two = own[3], Prefix(changed)
        return (own[1], one.n, hashlib.sha256(changed.encode()).hexdigest(), one.fingerprint(), two.fingerprint(),
                one.likeness(two), one.likeness(after[3]))

    for b in batches:
        out = []
        for part, late, doc, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if held is None and late == 2:               # a further copy of the next range's first
                continue
            own = (part, doc, text, Prefix(text))
            if held is not None:
                out.append(row(held, own))
            elif late == 1 and first is None:
                first = own                              # perhaps no document has an id
            held = None if late == 2 else own
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES, strict=True)]
                                         if out else [pa.array([], t) for t in _TYPES], _FIELDS)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row(held, first or held), _TYPES, strict=True)],
                                         _FIELDS)


def fingerprints(df: DataFrame, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: the id, ``n_chars``, ``fingerprint``, and the comparison
    with the edited text and the next document."""
    work = df.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    spark = df.sparkSession
    bounds = range_bounds(work, "id", min(4096, blocks(spark)))
    last = max(0, len(bounds) - 1)
    part = range_of(F.col("id"), bounds)
    starts = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array(F.lit(None).cast("long"))
    place = F.struct(F.col("part"), F.when(F.col("id").isNull(), 1).otherwise(0).alias("late"))
    ahead = F.struct(F.when(F.col("part") == 0, F.lit(last)).otherwise(F.col("part") - 1).cast("int").alias("part"),
                     F.lit(2).alias("late"))
    rows = work.withColumn("part", part).withColumn(
        "to", F.explode(F.when(F.get(starts, F.col("part")) == F.col("id"), F.array(place, ahead)).otherwise(F.array(place))))
    rows = rows.select("to.part", "to.late", "id", "text")
    dealt = (rows.repartition("part").withColumn("tie", F.xxhash64("text"))
             .sortWithinPartitions("part", "late", "id", "tie", "text").select("part", "late", "id", "text"))
    return dealt.mapInArrow(_compare, SCHEMA).withColumnRenamed("id", id)
