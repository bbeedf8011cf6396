"""Words, word hashes and word n-gram hashes of whole Arrow string columns.

All functions work on the bytes of an Arrow column inside a task, a bounded
slice of rows at a time, so a batch of texts never becomes Python strings.
Hashes are 64 bits: equal words always have equal hashes; unequal ones collide
with probability 2**-64 per pair.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20            # working memory is about 40 to 60 bytes a byte of text
_BASE = np.uint64(0x9E3779B97F4A7C15)

#: Byte classes. White space is x20 and x09-x0D, as in the pattern [^\x20\x09-\x0D]+.
SPACES = np.ones(256, np.uint8)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
#: The same, with letters, digits and bytes of other scripts (1) apart from punctuation (2).
KINDS = np.full(256, 2, np.uint8)
KINDS[SPACES == 0] = 0
KINDS[0x30:0x3A] = KINDS[0x41:0x5B] = KINDS[0x61:0x7B] = KINDS[0x80:] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_POWER = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """At least ``n`` powers of the base, modulo 2**64 (kept for the task)."""
    global _POWER
    if len(_POWER) < n:
        with np.errstate(over="ignore"):
            _POWER = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 4096), _BASE)]))
    return _POWER


def column(arr) -> pa.Array:
    """One contiguous string array without NULLs (NULL: empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
        if isinstance(arr, pa.ChunkedArray):
            arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    return pc.fill_null(arr, "") if arr.null_count else arr


def raw(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and each row's offsets into them."""
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(arr.buffers()[1], np.int64 if wide else np.int32)
    offs = offs[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    body = arr.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(arr: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (a longer row stands alone)."""
    _, offs = raw(arr)
    at = 0
    while at < len(arr):
        end = int(np.searchsorted(offs, offs[at] + most, "right")) - 1
        end = min(max(end, at + 1), len(arr))
        yield at, end
        at = end


class Words:
    """The words of a slice of texts: byte spans, hashes and each row's first word."""

    def __init__(self, arr: pa.Array, *, classes: np.ndarray = SPACES, lower: bool = False):
        self.data, offs = raw(arr)
        data = LOWER[self.data] if lower else self.data
        kind = classes[data]
        change = np.ones(len(data) + 1, bool)
        change[1:-1] = kind[1:] != kind[:-1]
        change[offs] = True
        edges = np.flatnonzero(change)
        starts, ends = edges[:-1], edges[1:]
        word = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
        self.starts, self.ends = starts[word], ends[word]
        self.bounds = np.searchsorted(self.starts, offs)
        self.rows = np.repeat(np.arange(len(offs) - 1), np.diff(self.bounds))
        size = self.ends - self.starts
        if not len(size):
            self.hashes = np.zeros(0, np.uint64)
            return
        first = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(first, size)
        with np.errstate(over="ignore"):
            terms = _VALUE[data[kind > 0]] * powers(int(size.max()))[at]
            self.hashes = mix(np.add.reduceat(terms, first) + size.astype(np.uint64) * _BASE)

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, i: int) -> str:
        return self.data[self.starts[i]:self.ends[i]].tobytes().decode("utf-8", "replace")


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (``len - n + 1`` of them).

    The caller leaves out runs that cross from one row to the next."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(hashes) - n + 1, np.uint64)
        for j in range(n):
            out = out * _BASE + hashes[j:len(hashes) - n + 1 + j]
        return mix(out ^ np.uint64(n))


def shingles(words: Words, n: int) -> list[np.ndarray]:
    """Per row, the ascending distinct n-gram hashes of its words; a row with fewer
    than ``n`` words has its whole sequence as one; one without words has none."""
    grams, out = ngrams(words.hashes, n), []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        else:
            out.append(ngrams(words.hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out
