"""Byte-level BPE over a rank file: whole texts to token ids, and ids back to bytes.

Text is split as ``public_tokenizers.PATTERN`` splits it, without a regular expression.
Every code point has a class (letter, number, space, other white space, apostrophe,
other, and the letters that end a contraction). A small automaton reads the classes;
reading one is a function from states to states. These functions and all their
compositions are a finite set, so composition is one table, and the state before every
code point comes from an associative scan: blocks of code points are composed column by
column for all blocks at once, the blocks' totals are scanned the same way, and each
block's prefixes are composed with what lies before it. State and class then say where
a token's text begins. A text's first code point resets the state, so a slice of many
texts is scanned at once.

The classes are those of the tokenizer library itself (it is asked once which code
points are letters, numbers and white space: about 1,500 run boundaries go to the tasks),
because its Unicode tables may be newer than Python's.

Each distinct slice is merged once a worker: the adjacent pair of least rank goes first,
the leftmost of equal ones, for all new slices at once by arrays; its ids are kept by its
64-bit hash, up to ``KEPT`` slices (beyond it the worker starts afresh). Long slices are
merged with a heap, so one word of a megabyte stays n log n.

Results, one row a row of the input, in a map without a shuffle:
``encode``: the id (any type, NULL and repeats kept), ``n_tokens``, ``ids`` (token file
format: little-endian unsigned 32-bit), ``starts`` (the same format: the byte of the text
that each token begins at). ``decode`` adds the bytes of the ids. NULL text is empty: no
tokens, empty binaries. No rows: no rows. Other columns never enter, so clashing names
are harmless.
"""
from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .words import _BASE, _VALUE, column, mix, powers, raw, slices

KEPT = 1_000_000
LONG = 48                         # bytes, from which a heap finds the next pair
BLOCK = 64
NONE = 1 << 30                    # above every rank

# classes of code points
(LETTER, ENDING, R_OR_V, E, ELL, NUMBER, OTHER, QUOTE, SPACE, WHITE) = range(10)
# states: what the last code point was; after a quote that opens a token, what it may become
(FRESH, IN_LETTERS, IN_NUMBER, IN_OTHER, AT_SPACE, AT_WHITE, AT_QUOTE, QUOTE_RV, QUOTE_L, SHORTENED) = range(10)
HERE, BEFORE = 1, 2               # a token begins at this code point, at the one before it


def _read(state: int, kind: int) -> tuple[int, int]:
    """Next state, and where tokens begin, after reading a code point of class ``kind``."""
    if state in (QUOTE_RV, QUOTE_L):
        if kind == (E if state == QUOTE_RV else ELL):
            return SHORTENED, 0
        after, begins = _read(IN_LETTERS, kind)            # no contraction: its letter began a token
        return after, begins | BEFORE
    if state == AT_QUOTE and kind <= ELL:
        if kind in (R_OR_V, ELL):
            return (QUOTE_RV if kind == R_OR_V else QUOTE_L), 0
        return (SHORTENED, 0) if kind == ENDING else (IN_LETTERS, HERE)
    if kind in (SPACE, WHITE):                             # white space in a run begins nothing by itself
        return (AT_SPACE if kind == SPACE else AT_WHITE), (0 if state in (AT_SPACE, AT_WHITE) else HERE)
    if state == AT_SPACE:                                  # the last space of a run goes with what follows
        return {NUMBER: IN_NUMBER, OTHER: IN_OTHER, QUOTE: IN_OTHER}.get(kind, IN_LETTERS), BEFORE
    gap = BEFORE if state == AT_WHITE else 0
    if kind <= ELL:
        return IN_LETTERS, gap | (0 if state == IN_LETTERS else HERE)
    if kind == NUMBER:
        return IN_NUMBER, gap | (0 if state == IN_NUMBER else HERE)
    if state in (IN_OTHER, AT_QUOTE):
        return IN_OTHER, 0
    return (AT_QUOTE if kind == QUOTE else IN_OTHER), gap | HERE


class Automaton:
    """The automaton's functions closed under composition, and the scan over them."""

    def __init__(self):
        states = range(10)
        plain = [tuple(_read(s, k)[0] for s in states) for k in range(10)]
        first = [(_read(FRESH, k)[0],) * 10 for k in range(10)]       # a text's first code point
        same = tuple(states)
        found = {same: 0}
        queue = [same]
        for f in queue:
            for g in plain + first:
                h = tuple(g[s] for s in f)
                if h not in found:
                    found[h] = len(found)
                    queue.append(h)
        self.many = len(found)                                        # 18
        self.generator = np.array([found[f] for f in plain + first], np.int32)
        self.compose = np.array([found[tuple(g[s] for s in f)] for f in queue for g in queue], np.int32)
        self.from_fresh = np.array([f[FRESH] for f in queue], np.uint8)
        pending = [BEFORE if s in (QUOTE_RV, QUOTE_L) else 0 for s in states]
        self.begins = np.array([[_read(s, k)[1] for k in range(10)] + [HERE | pending[s]] * 10 for s in states], np.uint8)

    def scan(self, functions: np.ndarray) -> np.ndarray:
        """Composition of every prefix of ``functions`` (numbers of functions)."""
        n = len(functions)
        if n <= BLOCK:
            out = functions.copy()
            for i in range(1, n):
                out[i] = self.compose[out[i - 1] * self.many + out[i]]
            return out
        grid = np.zeros(-(-n // BLOCK) * BLOCK, np.int32)             # padded with the identity
        grid[:n] = functions
        grid = np.ascontiguousarray(grid.reshape(-1, BLOCK).T)
        for j in range(1, BLOCK):
            grid[j] = self.compose[grid[j - 1] * self.many + grid[j]]
        before = np.zeros(grid.shape[1], np.int32)
        before[1:] = self.scan(grid[-1])[:-1]
        return self.compose[before * self.many + grid].T.reshape(-1)[:n]

    def starts(self, kinds: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Places of ``kinds`` at which a token begins; ``firsts`` are the places at which texts begin."""
        kinds = np.append(kinds, 10).astype(np.int32)                 # a last reset ends what is pending
        kinds[firsts] += 10
        after = self.from_fresh[self.scan(self.generator[kinds])]
        state = np.zeros(len(kinds), np.int64)
        state[1:] = after[:-1]
        flags = self.begins.ravel()[state * 20 + kinds]
        begin = (flags & HERE) > 0
        begin[:-1] |= (flags[1:] & BEFORE) > 0
        return np.flatnonzero(begin[:-1])


@lru_cache(1)
def automaton() -> Automaton:
    return Automaton()


@lru_cache(1)
def class_runs() -> tuple[list[int], list[int]]:
    """(first code point, class) of every run of equal class, as the tokenizer library has them."""
    import tiktoken

    singles = {bytes([b]): b for b in range(256)}
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    kinds = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        probe = tiktoken.Encoding(f"class {kind}", pat_str=pattern, mergeable_ranks=singles, special_tokens={})
        found = bytes(probe.encode_ordinary(points)).decode()
        kinds[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    for kind, characters in ((ENDING, "stmd"), (R_OR_V, "rv"), (E, "e"), (ELL, "l"), (QUOTE, "'"), (SPACE, " ")):
        kinds[[ord(c) for c in characters]] = kind
    at = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1]))
    return at.tolist(), kinds[at].tolist()


def class_table(runs: tuple[list[int], list[int]]) -> np.ndarray:
    at, kinds = runs
    return np.repeat(np.array(kinds, np.uint8), np.diff([*at, 0x110000]))


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, the byte that each begins at) of UTF-8 bytes."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    point = data[at].astype(np.int32)
    wide = np.flatnonzero(point >= 0x80)
    if len(wide):
        lead, place = point[wide], at[wide]
        more = 1 + (lead >= 0xE0) + (lead >= 0xF0)
        value = lead & np.array([0, 0x1F, 0x0F, 0x07])[more]
        for j in (1, 2, 3):
            longer = np.flatnonzero(more >= j)
            value[longer] = (value[longer] << 6) | (data[place[longer] + j] & 0x3F)
        point[wide] = value
    return point, at


class Coder:
    """Encoder and decoder of one rank file; keeps pairs and slices that it has seen."""

    def __init__(self, path: str, runs: tuple[list[int], list[int]], most: int = KEPT):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {r: b for b, r in self.ranks.items()}
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        top = max(self.bytes_of) + 1
        size = np.zeros(top + 1, np.int64)
        for r, b in self.bytes_of.items():
            size[r + 1] = len(b)
        self.offsets = np.cumsum(size)
        self.flat = np.frombuffer(b"".join(self.bytes_of.get(r, b"") for r in range(top)), np.uint8)
        halves = [(self.ranks[b[:i]] * top + self.ranks[b[i:]], r) for b, r in self.ranks.items()
                  for i in range(1, len(b)) if b[:i] in self.ranks and b[i:] in self.ranks]
        pairs = np.array(sorted(halves), np.int64).reshape(-1, 2)
        self.pair_keys, self.pair_ranks = (pairs[:, 0].copy(), pairs[:, 1].copy()) if len(pairs) else (np.full(1, -1), np.full(1, NONE))
        self.kinds, self.most, self.top = class_table(runs), most, top
        self.clear()

    def clear(self) -> None:
        self.keys, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)       # by key, in ids

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of every pair (a, b), ``NONE`` where their bytes together have none."""
        key = a * self.top + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of slices, one behind the other, and how many each has. In a round every slice
        that still has a ranked pair merges one: that of least rank, the leftmost of equal ones."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []       # (slice numbers, ids each, ids)
        rest = []
        for k, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                found.append((np.array([k]), np.array([1]), np.array([whole])))
            elif len(piece) >= LONG:
                ids = self._merge_long([self.single[x] for x in piece])
                found.append((np.array([k]), np.array([len(ids)]), np.array(ids)))
            else:
                rest.append(k)
        which = np.array(rest, np.int64)
        size = np.array([len(pieces[k]) for k in rest], np.int64)
        ids = np.array(self.single, np.int64)[np.frombuffer(b"".join(pieces[k] for k in rest), np.uint8)]
        cost = np.full(len(ids), NONE)                     # of a place and the next one in its slice
        if len(ids):
            cost[:-1] = self._pairs(ids[:-1], ids[1:])
            cost[np.cumsum(size) - 1] = NONE
        while len(which):
            first = np.cumsum(size) - size
            best = np.minimum.reduceat(cost * len(ids) + np.arange(len(ids)), first)
            rank, at = best // len(ids), best % len(ids)
            over = rank == NONE
            if over.any():                                 # these slices are done
                of = np.repeat(over, size)
                found.append((which[over], size[over], ids[of]))
                shift = np.cumsum(of)
                which, size, rank, at = which[~over], size[~over], rank[~over], (at - shift[at])[~over]
                ids, cost = ids[~of], cost[~of]
                if not len(which):
                    break
            ids[at] = rank                                 # the rank of the bytes is the id
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at, size = at - np.arange(len(at)), size - 1   # one place goes from every slice before
            ids, cost = ids[keep], cost[keep]
            last = np.cumsum(size) - 1
            inner = at < last
            cost[at] = NONE
            cost[at[inner]] = self._pairs(rank[inner], ids[at[inner] + 1])
            later = at > last - size + 1
            cost[at[later] - 1] = self._pairs(ids[at[later] - 1], rank[later])
        if not found:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        number, many, flat = (np.concatenate(x) for x in zip(*found, strict=True))
        start, order = np.cumsum(many) - many, np.argsort(number)
        many = many[order]
        done = np.cumsum(many)
        return flat[np.repeat(start[order] - (done - many), many) + np.arange(int(done[-1]))].astype(np.uint32), many

    def _pair(self, a: int, b: int) -> int:
        return self.ranks.get(self.bytes_of[a] + self.bytes_of[b], NONE)

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i) for i in range(n - 1) if (r := self._pair(ids[i], ids[i + 1])) != NONE]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or self._pair(ids[i], ids[j]) != rank:
                continue                                   # one of the two has been merged meanwhile
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := self._pair(rank, ids[k])) != NONE:
                    heapq.heappush(heap, (r, i))
            if (k := before[i]) >= 0 and (r := self._pair(ids[k], rank)) != NONE:
                heapq.heappush(heap, (r, k))
        return [x for x in ids if x >= 0]

    def spans(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte spans of the slices to merge, in order."""
        point, at = code_points(data)
        texts = offs[:-1][offs[1:] > offs[:-1]]
        starts = at[automaton().starts(self.kinds[point], np.searchsorted(at, texts))]
        return starts, np.append(starts[1:], len(data))

    def encode(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of a slice of texts, the byte that each begins at in its text, and the ids a text has."""
        data, offs = raw(arr)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(len(arr), np.int64)
        starts, ends = self.spans(data, offs)
        size = ends - starts
        with np.errstate(over="ignore"):
            place = np.arange(len(data)) - np.repeat(starts, size)
            terms = _VALUE[data] * powers(int(size.max()))[place]
            hashes = mix(np.add.reduceat(terms, starts) + size.astype(np.uint64) * _BASE)
        keys, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~known)
        if len(new):
            body = data.tobytes()
            flat, many = self.merge([body[a:b] for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)])
            self.first = np.insert(self.first, at[new], len(self.ids) + np.cumsum(many) - many)
            self.size = np.insert(self.size, at[new], many)
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.ids = np.concatenate([self.ids, flat])
            at = np.searchsorted(self.keys, keys)
        at = at[which]
        many = self.size[at]
        done = np.cumsum(many)
        ids = self.ids[np.repeat(self.first[at] - (done - many), many) + np.arange(int(done[-1]))]
        length = self.offsets[ids + 1] - self.offsets[ids]           # tokens cover the bytes without gaps
        begin = np.cumsum(length) - length
        of_text = np.searchsorted(begin, offs)
        per_text = np.diff(of_text)
        return ids, (begin - np.repeat(offs[:-1], per_text)).astype(np.uint32), per_text

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids, one behind the other."""
        if not len(ids):
            return np.zeros(0, np.uint8)
        size = self.offsets[ids + 1] - self.offsets[ids]
        done = np.cumsum(size)
        return self.flat[np.repeat(self.offsets[ids] - (done - size), size) + np.arange(int(done[-1]))]


_CODERS: dict[str, Coder] = {}


def coder(path: str, runs: tuple[list[int], list[int]]) -> Coder:
    """The worker's coder of ``path``: tasks that share a Python worker share what it keeps."""
    if path not in _CODERS:
        _CODERS.clear()
        _CODERS[path] = Coder(path, runs)
    return _CODERS[path]


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary column of consecutive byte spans that end at ``ends`` (in bytes)."""
    offs = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offs), pa.py_buffer(data.tobytes())])


def encode(df: DataFrame, path: str, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: the id, ``n_tokens``, ``ids`` and ``starts`` (see the module)."""
    runs = class_runs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, runs)
        for b in batches:
            arr = column(b.column(1))
            for lo, hi in slices(arr):
                ids, starts, many = own.encode(arr.slice(lo, hi - lo))
                ends = 4 * np.cumsum(many)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(many, pa.int64()), _binary(ids.astype("<u4"), ends),
                     _binary(starts.astype("<u4"), ends)], ["key", "n_tokens", "ids", "starts"])

    work = df.select(F.col(id).alias("key"), F.col(text).cast("string").alias("text"))
    schema = StructType([work.schema["key"], StructField("n_tokens", LongType()), StructField("ids", BinaryType()),
                         StructField("starts", BinaryType())])
    return work.mapInArrow(run, schema).withColumnRenamed("key", id)


def decode(df: DataFrame, path: str, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its ``ids`` (NULL: empty) as ``decoded``, a new name."""
    runs = class_runs()
    if decoded in df.columns:
        raise ValueError(f"column {decoded} exists")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, runs)
        for b in batches:
            at, col = b.schema.get_field_index(ids), b.column(ids)
            col = pa.array([x.as_py() or b"" for x in col], col.type) if col.null_count else col
            parts, ends, total = [], np.zeros(0, np.int64), 0
            for lo, hi in slices(col):
                data, offs = raw(col.slice(lo, hi - lo))
                flat = data.view(np.uint8).tobytes()
                tokens = np.frombuffer(flat, "<u4")
                upto = np.concatenate([[0], np.cumsum(own.offsets[tokens + 1] - own.offsets[tokens])])[offs[1:] // 4]
                parts.append(own.decode(tokens))
                ends, total = np.concatenate([ends, upto + total]), total + len(parts[-1])
            del at
            yield b.append_column(decoded, _binary(np.concatenate(parts) if parts else np.zeros(0, np.uint8), ends))

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(decoded, BinaryType())]))


def round_trip(df: DataFrame, path: str, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Digests of what ``encode`` and ``decode`` give: the id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``."""
    out = decode(encode(df, path, text=text, id=id).select(id, "n_tokens", "ids"), path)
    return out.select(id, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
