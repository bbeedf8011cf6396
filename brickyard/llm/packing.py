"""Packing documents into sequences by cutting-stock column generation.

A document's tokens (with an end token behind them) are cut into whole sequences of
``size`` tokens and a rest. Rests are the items of a cutting-stock problem: lengths
rounded up to ``size / 256`` tokens make at most 256 classes, patterns are
combinations of classes that fit one sequence. The linear program over patterns is
solved by column generation: the simplex basis gives dual prices, an unbounded
knapsack over lengths prices the best new pattern, until none improves. Pattern
counts are rounded down; the few items left over go first-fit decreasing into
patterns of their own. Only the histogram of classes (256 numbers) reaches the driver.

Pieces are ranked within their class by (task, place in it): local counts in the
tokenizing pass, then offsets by task from a table of counts by task and class, so a
class that holds a third of all pieces isn't sorted in one task. A rank gives the
pattern, the sequence and, by a window over one sequence's pieces, the offset.

Every id of every document lies in one piece. NULL and empty texts are the end token
alone. Rows that repeat an id are documents of their own. Ids may be NULL. No rows:
no rows. Text is encoded whole, special strings included, as the tokenizer does it;
where its white space is plain, unit by unit (a run of white space and the run of
other characters behind it: the split pattern never crosses the end of a unit), each
distinct unit once.
"""
from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import small, written
from .words import Words, column, mix, raw, slices

SIZE = 2048
CLASSES = 256
END = 1
GAP = 1e-4                       # of the number of sequences, at which column generation ends
MAX_UNITS = 1_000_000
#: Other white space (in UTF-8) joins runs across units; "<|" may begin a special string.
_OTHER = [b"<|"] + [chr(c).encode() for c in (
    0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


class Encoder:
    """Token ids of a column of texts; those of distinct units are kept, by hash, up to a bound."""

    def __init__(self, path: str, most: int = MAX_UNITS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.clear()

    def clear(self) -> None:
        self.keys, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)     # by key, in ids

    def _encode(self, texts: list[str]) -> list[array]:
        return [array("I", e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def units(arr: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a slice: (words, starts, ends, rows, hashes) of its units in order; white
        space at a text's end is a unit too."""
        w = Words(arr)
        data, offs = raw(arr)
        n = len(offs) - 1
        last = np.where(w.bounds[1:] > w.bounds[:-1], w.ends[np.maximum(w.bounds[1:] - 1, 0)] if len(w) else 0, offs[:-1])
        starts = np.zeros(len(w), np.int64)
        starts[1:] = w.ends[:-1]
        opening = w.bounds[:-1][w.bounds[1:] > w.bounds[:-1]]
        starts[opening] = offs[:-1][w.rows[opening]]
        tails = np.flatnonzero(last < offs[1:])
        rows = np.concatenate([w.rows, tails])
        starts, begins = np.concatenate([starts, last[tails]]), np.concatenate([w.starts, offs[1:][tails]])
        ends, hashes = np.concatenate([w.ends, offs[1:][tails]]), np.concatenate([w.hashes, np.zeros(len(tails), np.uint64)])
        gap = begins - starts
        code = np.zeros(len(gap), np.uint64)
        code[gap == 1] = data[starts[gap == 1]].astype(np.uint64) + np.uint64(1)
        for i in np.flatnonzero(gap > 1).tolist():
            code[i] = (zlib.crc32(data[starts[i]:begins[i]].tobytes()) << 20 | int(gap[i])) + 512
        with np.errstate(over="ignore"):
            hashes = mix(hashes + mix(code))
        order = np.argsort(starts, kind="stable") if len(tails) else slice(None)
        return w, starts[order], ends[order], rows[order], hashes[order]

    def encode(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice of texts, and the number of ids of each text."""
        w, starts, ends, rows, hashes = self.units(arr)
        body = w.data.tobytes()
        apart = np.zeros(len(arr), bool)
        other = [x for x in _OTHER if x in body]
        if other:
            offs = raw(arr)[1].tolist()
            apart = np.array([any(body.find(x, lo, hi) >= 0 for x in other) for lo, hi in zip(offs[:-1], offs[1:], strict=True)])
            plain = ~apart[rows]
            starts, ends, rows, hashes = starts[plain], ends[plain], rows[plain], hashes[plain]
        keys, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~known)
        found = self._encode([body[a:b].decode() for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)])
        size = np.array([len(x) for x in found], np.int64)
        joined = np.frombuffer(b"".join(x.tobytes() for x in found), np.uint32)
        self.first = np.insert(self.first, at[new], len(self.ids) + np.cumsum(size) - size)
        self.size = np.insert(self.size, at[new], size)
        self.keys = np.insert(self.keys, at[new], keys[new])
        self.ids = np.concatenate([self.ids, joined])
        at = np.searchsorted(self.keys, keys)[which]
        size = self.size[at]
        src = np.repeat(self.first[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        ids, many = self.ids[src], np.bincount(rows, size, len(arr)).astype(np.int64)
        if apart.any():                                          # texts that are encoded whole
            parts, place = [], np.concatenate([[0], np.cumsum(many)])
            for i in range(len(arr)):
                parts.append(np.array(self._encode([arr[i].as_py()])[0], np.uint32) if apart[i] else ids[place[i]:place[i + 1]])
            ids, many = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return ids, many


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The worker's encoder of ``path``: tasks that share a Python worker share what it keeps, up to ``MAX_UNITS``."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def knapsack(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Best value and counts of items in ``room`` units, any number of each."""
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(int(sizes[0]), room + 1):                # sizes ascend
        fit = np.searchsorted(sizes, c, "right")
        value = prices[:fit] + best[c - sizes[:fit]]
        k = int(value.argmax())
        best[c], took[c] = (value[k], k) if value[k] > best[c - 1] else (best[c - 1], -2)
    counts, c = np.zeros(len(sizes), np.int64), room
    while c > 0 and took[c] != -1:
        if took[c] == -2:
            c -= 1
        else:
            counts[took[c]] += 1
            c -= int(sizes[took[c]])
    return float(best[room]), counts


def first_basis(sizes: np.ndarray, need: np.ndarray, room: int) -> np.ndarray:
    """Patterns filled from the largest class down, each used until a class runs out:
    one column for each class, triangular in the order in which they run out."""
    left, columns = need.copy(), np.zeros((len(sizes), len(sizes)))
    while (left > 0).any():
        free, own = room, np.zeros(len(sizes))
        for i in np.flatnonzero(left > 0)[::-1]:
            own[i] = free // sizes[i]
            free -= int(own[i]) * int(sizes[i])
        times = np.where(own > 0, left / np.maximum(own, 1), np.inf)
        out = int(np.argmin(times))
        left = np.maximum(left - times[out] * own, 0.0)
        left[left < 1e-9 * need] = 0.0
        left[out] = 0.0
        columns[:, out] = own
    for i in np.flatnonzero(columns.diagonal() == 0):        # ran out together with another
        columns[:, i] = 0
        columns[i, i] = room // sizes[i]
    return columns


def _inverse(m: np.ndarray) -> np.ndarray:
    """Inverse by Gauss-Jordan steps (no BLAS threads on a busy driver)."""
    n = len(m)
    both = np.concatenate([m, np.eye(n)], axis=1)
    for i in range(n):
        k = i + int(np.argmax(np.abs(both[i:, i])))
        both[[i, k]] = both[[k, i]]
        both[i] /= both[i, i]
        factor = both[:, i].copy()
        factor[i] = 0.0
        both -= factor[:, None] * both[i]
    return both[:, n:]


def _times(m: np.ndarray, v: np.ndarray) -> np.ndarray:
    return (m * v).sum(axis=1)


def patterns(demand: dict[int, int], room: int = CLASSES, rounds: int = 2_000) -> list[tuple[dict[int, int], int]]:
    """(pattern, number of sequences) that hold ``demand`` (items by class, class k
    taking k units of ``room``), by column generation."""
    sizes = np.array(sorted(k for k, n in demand.items() if n), np.int64)
    if not len(sizes):
        return []
    need = np.array([demand[int(k)] for k in sizes], float)
    columns = first_basis(sizes, need, room)
    inverse = _inverse(columns)
    used = np.maximum(_times(inverse, need), 0.0)
    for turn in range(rounds):
        if turn % 100 == 99:                                 # against rounding errors
            inverse = _inverse(columns)
            used = np.maximum(_times(inverse, need), 0.0)
        value, counts = knapsack(np.maximum(inverse.sum(axis=0), 0.0), sizes, room)
        if value <= 1 + GAP:                 # the optimum is at least the present one / value
            break
        move = _times(inverse, counts)
        ratio = np.where(move > 1e-9, used / np.where(move > 1e-9, move, 1.0), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        step = ratio[out]
        used = np.maximum(used - step * move, 0.0)
        used[out] = step
        columns[:, out] = counts
        pivot = inverse[out] / move[out]
        inverse = inverse - np.outer(move, pivot)
        inverse[out] = pivot
    left, whole = need.astype(np.int64), np.zeros(len(sizes), np.int64)
    for k in np.argsort(-used, kind="stable"):               # rounded down, and never beyond what is left
        own = columns[:, k].astype(np.int64)
        whole[k] = max(0, min(int(used[k] + 1e-6), int((left[own > 0] // own[own > 0]).min())))
        left -= whole[k] * own
    made = [({int(s): int(n) for s, n in zip(sizes, columns[:, k], strict=True) if n}, int(whole[k]))
            for k in range(len(sizes)) if whole[k]]
    bins: list[tuple[dict[int, int], int]] = []              # (pattern, free units)
    free = np.zeros(0, np.int64)
    for k in np.argsort(-sizes):
        for _ in range(int(left[k])):
            fit = np.flatnonzero(free >= sizes[k])
            if not len(fit):
                bins.append(({}, 0))
                free, fit = np.append(free, room), np.array([len(free)])
            at = int(fit[0])
            bins[at][0][int(sizes[k])] = bins[at][0].get(int(sizes[k]), 0) + 1
            free[at] -= sizes[k]
    return made + [(own, 1) for own, _ in bins]


def _pieces(path: str, size: int, end: int):
    unit = size // CLASSES
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, seen = encoder_of(path), TaskContext.get().partitionId(), [0] * (CLASSES + 1)
        for b in batches:
            out = []
            docs, arr = b.column(0).to_pylist(), column(b.column(1))
            for lo, hi in slices(arr):
                flat, many = encoder.encode(arr.slice(lo, hi - lo))
                flat, at = flat.astype("<u4").tobytes(), 0
                for doc, n in zip(docs[lo:hi], many.tolist(), strict=True):
                    ids, n, at = flat[4 * at:4 * (at + n)] + tail, n + 1, at + n
                    for start in range(0, n, size):
                        length = min(size, n - start)
                        kind = -(-length // unit)
                        crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                        out.append((doc, start, length, crc, n, kind, task, seen[kind]))
                        seen[kind] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 8, _TYPES, strict=True)], _NAMES)

    return run


_NAMES = ["id", "start", "length", "ids_crc32", "doc_tokens", "kind", "task", "local"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
_SCHEMA = "id long, start long, length long, ids_crc32 long, doc_tokens long, kind int, task int, local long"


def pack(df: DataFrame, tokenizer_path: str, *, text: str = "text", id: str = "doc_id", size: int = SIZE,
         end: int = END) -> DataFrame:
    """One row per piece: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    work = df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    pieces = written(work.mapInArrow(_pieces(tokenizer_path, size, end), _SCHEMA), "packing-pieces")
    counts = pieces.groupBy("kind", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("kind").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "packing-counts")
    demand = {r["kind"]: r["n"] for r in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}  # 256 numbers

    base, slots = 0, {}                 # by class: upper ranks, first sequence, items a sequence
    for own, times in patterns(demand):
        for kind, n in own.items():
            upto, first, many = slots.setdefault(kind, ([0], [], []))
            upto.append(upto[-1] + n * times)
            first.append(base)
            many.append(n)
        base += times
    slots = {k: tuple(np.array(v, np.int64) for v in got) for k, got in slots.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kind, rank = b.column("kind").to_numpy(), b.column("rank").to_numpy()
            seq = np.zeros(len(kind), np.int64)
            for k in np.unique(kind).tolist():
                at = np.flatnonzero(kind == k)
                upto, first, many = slots[k]
                p = np.searchsorted(upto, rank[at], "right") - 1
                seq[at] = first[p] + (rank[at] - upto[p]) // many[p]
            yield b.append_column("sequence_id", pa.array(seq))

    ranked = pieces.join(small(counts.select("kind", "task", "before"), 24), ["kind", "task"])
    ranked = ranked.select("id", "start", "length", "ids_crc32", "doc_tokens", "kind", (F.col("before") + F.col("local")).alias("rank"))
    placed = ranked.mapInArrow(place, "id long, start long, length long, ids_crc32 long, doc_tokens long, kind int, "
                                      "rank long, sequence_id long")
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("kind"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(F.col("id").alias(id), "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))
