"""Exact dedup with a cuckoo-filter index over live digests.

Texts are equal when identical after lower-casing A-Z; of equal texts the row with
the largest id stays. The digest is the SHA-256 of the normalised text in UTF-8.

``Index`` is a cuckoo filter (buckets of four 16-bit fingerprints, two places a
digest) beside buckets of stored content (digest, best row, rows). A digest that the
filter hasn't is new; a hit is verified against the bucket's whole digests. When a
later row takes over, the live entry is deleted and the new one inserted; overflow
of the filter resizes it from the stored keys.

1. Each scan task indexes its own rows: one output row per input row, and the live
   entry of each digest carries its local row count. So a group that holds a third
   of all rows leaves one entry a task.
2. Live entries are dealt out by digest (one a task and digest) and each block is
   indexed again: the best row and the size of each group.
3. Groups join the narrow rows on the digest, an equi-join that AQE splits.

NULL text is empty. NULL ids count as smaller than any other. Rows that repeat an id
and a text are one group; exactly one of them stays. No rows: no rows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import blocks, written
from .words import column, raw

SLOTS = 4
KICKS = 200


class Cuckoo:
    """Cuckoo filter: each digest's fingerprint lies in one of two buckets."""

    def __init__(self, buckets: int = 1 << 10):
        self.mask, self.table = buckets - 1, [[] for _ in range(buckets)]

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        print_ = int.from_bytes(digest[:2], "little") or 1
        i = int.from_bytes(digest[2:8], "little") & self.mask
        return print_, i, self._other(i, print_)

    def _other(self, i: int, print_: int) -> int:
        return (i ^ (print_ * 0x5BD1E995)) & self.mask

    def __contains__(self, digest: bytes) -> bool:
        p, i, j = self._places(digest)
        return p in self.table[i] or p in self.table[j]

    def insert(self, digest: bytes) -> bool:
        """False if no slot was found: the filter is then to be rebuilt, larger."""
        p, i, j = self._places(digest)
        for at in (i, j):
            if len(self.table[at]) < SLOTS:
                self.table[at].append(p)
                return True
        at = j
        for kick in range(KICKS):
            slot = kick % SLOTS
            self.table[at][slot], p = p, self.table[at][slot]
            at = self._other(at, p)
            if len(self.table[at]) < SLOTS:
                self.table[at].append(p)
                return True
        return False

    def delete(self, digest: bytes) -> None:
        p, i, j = self._places(digest)
        for at in (i, j):
            if p in self.table[at]:
                self.table[at].remove(p)
                return


class Index:
    """Live digests: filter in front, buckets of stored content behind."""

    def __init__(self):
        self.filter, self.content, self.live = Cuckoo(), {}, 0

    def find(self, digest: bytes) -> list | None:
        """The live entry [digest, best, rows] of a digest."""
        if digest not in self.filter:
            return None
        return next((e for e in self.content.get(digest[8:11], ()) if e[0] == digest), None)

    def insert(self, digest: bytes, best, rows: int) -> None:
        self.content.setdefault(digest[8:11], []).append([digest, best, rows])
        self.live += 1
        if not self.filter.insert(digest):
            buckets = 2 * (self.filter.mask + 1)
            while True:
                self.filter = Cuckoo(buckets)
                if all(self.filter.insert(e[0]) for own in self.content.values() for e in own):
                    break
                buckets *= 2

    def delete(self, digest: bytes) -> None:
        bucket = self.content[digest[8:11]]
        bucket[:] = [e for e in bucket if e[0] != digest]
        self.filter.delete(digest)
        self.live -= 1

    def add(self, digest: bytes, best, rows: int = 1) -> None:
        """Count ``rows`` more; the larger ``best`` is the live one."""
        held = self.find(digest)
        if held is None:
            self.insert(digest, best, rows)
        elif best > held[1]:
            self.delete(digest)
            self.insert(digest, best, held[2] + rows)
        else:
            held[2] += rows

    def entries(self) -> Iterator[list]:
        for own in self.content.values():
            yield from own


LEAST = -(1 << 63)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index, at = Index(), TaskContext.get().partitionId() << 40
    for b in batches:
        ids = b.column(0).to_pylist()
        data, offs = raw(column(b.column(1)))
        data, offs = data.tobytes(), offs.tolist()
        digests = [hashlib.sha256(data[lo:hi].lower()).digest()       # bytes.lower: A-Z only
                   for lo, hi in zip(offs[:-1], offs[1:], strict=True)]
        for k, (doc, digest) in enumerate(zip(ids, digests, strict=True)):
            index.add(digest, (LEAST if doc is None else doc, at + k))
        n = len(ids)
        yield _rows(ids, digests, list(range(at, at + n)), [0] * n)
        at += n
    live = list(index.entries())
    yield _rows([e[1][0] for e in live], [e[0] for e in live], [e[1][1] for e in live], [e[2] for e in live])


def _rows(ids, digests, uids, rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(uids, pa.int64()),
         pa.array(rows, pa.int64())], ["id", "digest", "uid", "rows"])


def _merge(table: pa.Table) -> pa.Table:
    index = Index()
    for doc, digest, uid, rows in zip(*(table[c].to_pylist() for c in ("id", "digest", "uid", "rows")), strict=True):
        index.add(digest, (doc, uid), rows)
    live = list(index.entries())
    return pa.table({"digest": pa.array([e[0] for e in live], pa.binary()),
                     "keep": pa.array([e[1][0] for e in live], pa.int64()),
                     "keep_uid": pa.array([e[1][1] for e in live], pa.int64()),
                     "size": pa.array([e[2] for e in live], pa.int64())})


def exact_dedup(df: DataFrame, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    work = df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    table = written(work.mapInArrow(_digests, "id long, digest binary, uid long, rows long"), "exact-dedup")
    block = F.pmod(F.xxhash64("digest"), F.lit(blocks(df.sparkSession)))
    groups = (table.where("rows > 0").withColumn("block", block).groupBy("block")
              .applyInArrow(_merge, "digest binary, keep long, keep_uid long, size long"))
    rows = table.where("rows = 0").select("id", "uid", "digest")
    return rows.join(groups, "digest").select(
        F.col("id").alias(id), F.expr(f"nullif(keep, {LEAST + 1} - 1)").alias("keep_id"),
        F.col("size").alias("group_size"), (F.col("uid") == F.col("keep_uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h)
"""
