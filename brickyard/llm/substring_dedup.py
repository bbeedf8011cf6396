"""Substring dedup by fixed-block anchors.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is ``WINDOW`` (20) consecutive
words of one document; a word goes if it is covered by a window whose words also start
earlier (smaller id, or earlier in the same document). Windows are judged on the input.

Any window holds a whole block of ``BLOCK`` (10) words at a multiple of 10. So:

1. Anchors. The non-overlapping blocks of every document are the reference index; the
   rolling 10-word windows of every document probe it. Both travel as sorted 32-bit
   remainders of their hashes in hash buckets, distinct within a range of documents;
   a bucket answers each range with those of its windows that equal a block and
   occur elsewhere too. (Remainders may collide: that only adds work to step 2.)
2. Extension. Around its hits a range takes the 20-word windows that cover one; a
   later and an earlier equal window both hold a hit, the earlier one's block. Their
   64-bit hashes go to buckets, which answer each range with those that a range of
   smaller ids has too.
3. Each range marks windows that step 2 names or that start earlier in the range;
   runs of marked windows are the maximal exact repeats, and their words go.

Documents are dealt into ranges of ids of about ``RANGE_ROWS`` rows once (the three
steps share that exchange), so a passage that any number of documents repeat is one
entry a range, never a group of documents, and no pair is ever made.

NULL text has no words. NULL ids come last. Rows that repeat an id are documents of
their own, by text order. Documents of fewer than 20 words lose nothing. No rows: no
rows. Unequal windows with equal 64-bit hashes would be taken as equal.
"""
from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import range_of, ranges_for
from .words import Words, column, ngrams, raw, slices

WINDOW = 20
BLOCK = 10
RANGE_ROWS = 1024


class Range:
    """The documents of a range in order, with the hashes of their words."""

    def __init__(self, table: pa.Table):
        order = pc.sort_indices(table, sort_keys=[("id", "ascending"), ("text", "ascending")], null_placement="at_end")
        table = table.take(order)
        self.ids, self.texts = table["id"], column(table["text"])
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for lo, hi in slices(self.texts):
            w = Words(self.texts.slice(lo, hi - lo))
            hashes.append(w.hashes)
            counts.append(np.diff(w.bounds))
        self.hashes, self.counts = np.concatenate(hashes), np.concatenate(counts)
        self.first = np.repeat(np.cumsum(self.counts) - self.counts, self.counts)     # by word: its document's first
        self.end = self.first + np.repeat(self.counts, self.counts)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the windows of ``n`` words."""
        at = np.flatnonzero(np.arange(len(self.hashes)) + n <= self.end)
        return at, ngrams(self.hashes, n)[at] if len(at) else np.zeros(0, np.uint64)


def _split(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket (the upper bits) and 32-bit remainder (those below) of each hash."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    return bucket, (hashes >> np.uint64(32 - bits)).astype(np.uint32)


def _blobs(part: int, bucket: np.ndarray, keys: np.ndarray, flags: np.ndarray | None, schema: pa.Schema) -> pa.Table:
    """One row per bucket from rows in ascending order of bucket."""
    names, starts = np.unique(bucket, return_index=True)
    ends = np.append(starts, len(bucket))[1:]
    cols = {"part": [part] * len(names), "bucket": names.tolist(),
            "keys": [keys[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]}
    if flags is not None:
        cols["flags"] = [flags[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    return pa.table(cols, schema)


_SENT = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("flags", pa.binary())])
_PLAIN = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary())])
_SENT_SQL = "part int, bucket int, keys binary, flags binary"
_PLAIN_SQL = "part int, bucket int, keys binary"
ALIGNED, AGAIN = 1, 2


def _gather(table: pa.Table, kind) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a bucket's rows, and the range each came from."""
    keys = [np.frombuffer(x, kind) for x in table["keys"].to_pylist()]
    parts = np.repeat(table["part"].to_numpy(), [len(k) for k in keys])
    return np.concatenate([np.zeros(0, kind), *keys]), parts


def _answer(bucket: int, parts: np.ndarray, keys: np.ndarray) -> pa.Table:
    order = np.lexsort((keys, parts))
    out = _blobs(bucket, parts[order].astype(np.int64), keys[order], None, _PLAIN)
    return pa.table({"part": out["bucket"], "bucket": out["part"], "keys": out["keys"]}, _PLAIN)


def _anchors(bits: int):
    def run(key, table):
        docs = Range(table)
        at, grams = docs.windows(BLOCK)
        bucket, rest = _split(grams, bits)
        code = (bucket.astype(np.uint64) << np.uint64(32)) | rest
        order = np.argsort(code, kind="stable")
        code = code[order]
        new = np.ones(len(code), bool)
        new[1:] = code[1:] != code[:-1]
        starts = np.flatnonzero(new)
        aligned = ((at - docs.first[at]) % BLOCK == 0)[order]
        flags = np.zeros(len(starts), np.uint8)
        if len(starts):
            flags = (ALIGNED * np.logical_or.reduceat(aligned, starts)
                     + AGAIN * (np.diff(np.append(starts, len(code))) > 1)).astype(np.uint8)
        code = code[starts]
        return _blobs(key[0].as_py(), (code >> np.uint64(32)).astype(np.int64), code.astype(np.uint32), flags, _SENT)

    return run


def _match(key, table):
    """Keys that are some range's block and occur more than once, to the ranges that have them."""
    keys, parts = _gather(table, np.uint32)
    flags = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(x, np.uint8) for x in table["flags"].to_pylist()]])
    order = np.argsort(keys, kind="stable")
    keys, parts, flags = keys[order], parts[order], flags[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    if not len(starts):
        return _PLAIN.empty_table()
    size = np.diff(np.append(starts, len(keys)))
    any_ = np.bitwise_or.reduceat(flags, starts)
    good = np.repeat(((any_ & ALIGNED) > 0) & ((size > 1) | ((any_ & AGAIN) > 0)), size)
    return _answer(key[0].as_py(), parts[good], keys[good])


def _is_in(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def _extend(bits: int):
    def run(key, table, answers):
        docs = Range(table)
        held = [np.frombuffer(k, np.uint32).astype(np.uint64) | np.uint64(b << 32)
                for b, k in zip(answers["bucket"].to_pylist(), answers["keys"].to_pylist(), strict=True)]
        hits = np.sort(np.concatenate([np.zeros(0, np.uint64), *held]))
        at, grams = docs.windows(BLOCK)
        bucket, rest = _split(grams, bits)
        hit = np.zeros(len(docs.hashes) + 1, np.int64)
        hit[at + 1] = _is_in((bucket.astype(np.uint64) << np.uint64(32)) | rest, hits)
        upto = np.cumsum(hit)
        at, grams = docs.windows(WINDOW)
        covers = upto[at + WINDOW - BLOCK + 1] > upto[at] if len(at) else np.zeros(0, bool)
        found = np.unique(grams[covers])
        bucket, _ = _split(found, bits)
        return _blobs(key[0].as_py() if key[0].as_py() is not None else 0, bucket, found, None, _PLAIN)

    return run


def _earlier(key, table):
    """Windows that a range of smaller ids has, to the later ranges that have them."""
    keys, parts = _gather(table, np.uint64)
    order = np.lexsort((parts, keys))
    keys, parts = keys[order], parts[order]
    later = np.zeros(len(keys), bool)
    later[1:] = keys[1:] == keys[:-1]
    return _answer(key[0].as_py(), parts[later], keys[later])


_OUT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("kept_sha256", pa.string()), ("kept", pa.string())])


def _remove(with_text: bool):
    def run(key, table, answers):
        docs = Range(table)
        named = np.sort(np.concatenate([np.zeros(0, np.uint64),
                                        *[np.frombuffer(k, np.uint64) for k in answers["keys"].to_pylist()]]))
        at, grams = docs.windows(WINDOW)
        again = np.ones(len(at), bool)
        again[np.unique(grams, return_index=True)[1]] = False
        again |= _is_in(grams, named)
        edge = np.zeros(len(docs.hashes) + WINDOW + 1, np.int64)     # runs of marked windows: maximal repeats
        edge[at[again]] += 1
        edge[at[again] + WINDOW] -= 1
        gone = np.cumsum(edge)[:len(docs.hashes)] > 0
        removed = np.add.reduceat(np.append(gone, False), np.minimum(np.cumsum(docs.counts) - docs.counts, len(gone))) \
            * (docs.counts > 0) if len(docs.counts) else np.zeros(0, np.int64)
        data, offs = raw(docs.texts)
        data, offs, keep, shas, kepts, w = data.tobytes(), offs.tolist(), ~gone, [], [], 0
        for lo, hi, n, lost in zip(offs[:-1], offs[1:], docs.counts.tolist(), removed.tolist(), strict=True):
            words = data[lo:hi].split()              # bytes.split: x20 and x09-x0D
            body = b" ".join(compress(words, keep[w:w + n].tolist()) if lost else words)
            shas.append(hashlib.sha256(body).hexdigest())
            kepts.append(body.decode("utf-8", "replace") if with_text else None)
            w += n
        return pa.table({"id": docs.ids.combine_chunks(), "n_words": docs.counts, "n_removed": removed.astype(np.int64),
                         "kept_sha256": shas, "kept": pa.array(kepts, pa.string())}, _OUT)

    return run


def substring_dedup(df: DataFrame, *, text: str = "text", id: str = "doc_id", range_rows: int = RANGE_ROWS,
                    with_text: bool = False) -> DataFrame:
    """One row per row of ``df``: the id, ``n_words``, ``n_removed``, ``kept_sha256`` and, if
    asked for, the text of the kept words."""
    work = df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    bounds = ranges_for(work, "id", range_rows)
    bits = min(16, (max(1, len(bounds)) - 1).bit_length())           # as many buckets as ranges, 65,536 at most
    docs = work.withColumn("part", range_of(F.col("id"), bounds)).groupBy("part")
    sent = docs.applyInArrow(_anchors(bits), _SENT_SQL)
    hits = sent.groupBy("bucket").applyInArrow(_match, _PLAIN_SQL)
    found = docs.cogroup(hits.groupBy("part")).applyInArrow(_extend(bits), _PLAIN_SQL)
    named = found.groupBy("bucket").applyInArrow(_earlier, _PLAIN_SQL)
    out = docs.cogroup(named.groupBy("part")).applyInArrow(
        _remove(with_text), "id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.select(F.col("id").alias(id), "n_words", "n_removed", "kept_sha256", *["kept"] * with_text)


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(ws[s:s+19], ' ')) AS seq
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w WHERE len(ws) >= 20)),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) AS r FROM win),
gone AS (SELECT DISTINCT doc_id, s + j AS k FROM ranked, range(0, 20) t(j) WHERE r > 1),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS k FROM w),
kept AS (SELECT word.doc_id, count(gone.k) AS n_removed,
                string_agg(word, ' ' ORDER BY word.k) FILTER (WHERE gone.k IS NULL) AS body
         FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.k = gone.k GROUP BY word.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
