"""Phrase collocations: frequent runs of words whose parts are rarer apart than together.

Words and pieces come from the bytes of the text (A-Z lower-cased); a word's 64-bit hash
is the coefficient of a prefix polynomial, modulo 2**64, over all words of a slice of
texts, so the Rabin-Karp fingerprint of any run of words is one difference of prefixes
times a power of the inverse base, mixed with the run's length and language.

1. Every task counts words and word pairs in hashed slots; the counts are added slot by
   slot in a stream. A slot below the least count holds no frequent phrase, so a bitmap of
   slots (at most ``2**MOST_BITS`` of them: 32 MB) lets the next pass leave out what can't
   be frequent: a phrase is no more frequent than any pair in it. Slots that several
   phrases share only let more through.
2. Fingerprints of the runs left, 1 to ``longest`` words, are counted with pointers to the
   texts of two occurrences; map-side by arrays, then by a shuffle of packed counts dealt by
   ranges of fingerprints. A pointer is the hash of language and text, so ids may be NULL or
   repeat; the least two hashes are kept, which leads most phrases to the same few texts. Beside its fingerprint every occurrence carries a checksum of
   its words' bytes (other byte values, another base, 28 bits): occurrences that agree in
   the one but not in the other are counted apart.
3. Frequent fingerprints only are made into phrases: the texts that the pointers name are
   read, and what has the fingerprint in them is cut out as text and compared. Where two
   differ (two phrases share 92 bits), the fingerprint is counted again over all texts,
   every occurrence compared word by word with the one that stands for it.

The scores are joins over frequent phrases only: each cut of a candidate looks up its two
parts, which are frequent as well. Products are decimals of 38 digits. A candidate inside
a longer one of the same count is also inside one that is longer by a single word, since
counts can't rise from a phrase to a longer one; so a look at those suffices.

NULL text is empty, NULL language is ``und`` (and joins rows that say ``und``); repeated
rows count each time; ids may be of any type, NULL or repeat; no rows or no frequent phrase:
no rows. Extra columns never enter.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import blocks, small, written
from .words import LOWER, Words, column, mix, raw, slices

LEAST, LONGEST, TOP = 100, 5, 2000
MOST_BITS = 28
HELD = 2_000_000                     # fingerprints a task holds before it combines them
STRINGS = 200_000                    # phrases a task holds before it hands them on
LENGTH_BITS = 4                      # of a checksum, for the number of words of the run
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CUT = np.zeros(256, np.uint8)
_CUT[[ord(c) for c in ".,;:!?"]] = _CUT[0x0A:0x0E] = 1
_WORD = np.ones(256, np.uint8)
_WORD[[0x20, 0x09]] = 0
_WORD[_CUT > 0] = 0
_CHECK = np.uint64(0xD6E8FEB86659FD93)       # of the checksums: base of the bytes, and of the words
_CHECK_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _CHECK)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """At least ``n`` powers of ``base`` modulo 2**64 (kept by the worker)."""
    if len(_POWERS.get(base, ())) < n:
        with np.errstate(over="ignore"):
            _POWERS[base] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 1 << 16), np.uint64(base))]))
    return _POWERS[base]


class Runs:
    """Words of a slice of texts and the fingerprints of their runs within pieces."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        self.words = w = Words(texts, classes=_WORD, lower=True)
        self.data, offs = LOWER[w.data], raw(texts)[1]
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        self.lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[w.rows] if len(w) else np.zeros(0, np.int64)
        cuts = np.cumsum(_CUT[self.data], dtype=np.int64)
        piece = cuts[w.starts] if len(w) else np.zeros(0, np.int64)
        #: With the next word in one piece of one text.
        self.joined = np.zeros(len(w), bool)
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (w.rows[1:] == w.rows[:-1])
        salt = mix(np.array([zlib.crc32(x.encode()) + 1 for x in self.langs], np.uint64))
        self.salt = salt[self.lang] if len(w) else np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            self.prefix = np.zeros(len(w) + 1, np.uint64)
            np.cumsum(w.hashes * _powers(_BASE, len(w))[:len(w)], out=self.prefix[1:])

    def checks(self, at: np.ndarray, n: int) -> np.ndarray:
        """Checksum and length of the runs of ``n`` words from the places ``at``, as one int."""
        if not hasattr(self, "check_prefix"):
            w, base, inverse = self.words, int(_CHECK), pow(int(_CHECK), -1, 1 << 64)
            with np.errstate(over="ignore"):
                terms = np.zeros(len(self.data) + 1, np.uint64)
                np.cumsum(_CHECK_VALUE[self.data] * _powers(base, len(self.data))[:len(self.data)], out=terms[1:])
                own = mix((terms[w.ends] - terms[w.starts]) * _powers(inverse, len(self.data) + 1)[w.starts]
                          + (w.ends - w.starts).astype(np.uint64))
                self.check_prefix = np.zeros(len(w) + 1, np.uint64)
                np.cumsum(own * _powers(base, len(w))[:len(w)], out=self.check_prefix[1:])
        with np.errstate(over="ignore"):
            value = mix((self.check_prefix[at + n] - self.check_prefix[at]) * _powers(pow(int(_CHECK), -1, 1 << 64), len(self.words))[at])
        return ((value >> np.uint64(32 + LENGTH_BITS)).astype(np.int64) << LENGTH_BITS | n).astype(np.uint32).view(np.int32)

    def fingerprints(self, at: np.ndarray, n: int) -> np.ndarray:
        """Of the runs of ``n`` words from the places ``at``."""
        with np.errstate(over="ignore"):
            value = (self.prefix[at + n] - self.prefix[at]) * _powers(_INVERSE, len(self.words))[at]
            return mix((value ^ self.salt[at]) + np.uint64(n))

    def places(self, n: int) -> np.ndarray:
        """Where runs of ``n`` words in one piece begin."""
        ok = np.ones(max(0, len(self.words) - n + 1), bool)
        for j in range(n - 1):
            ok &= self.joined[j:j + len(ok)]
        return np.flatnonzero(ok)

    def word_ids(self) -> np.ndarray:
        """A number for each word, equal exactly where the bytes are: by hash, verified."""
        w = self.words
        _, one, which = np.unique(w.hashes, return_index=True, return_inverse=True)
        size = w.ends - w.starts
        same = size == size[one][which]
        if same.all() and len(w):
            place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            same = np.array([(self.data[np.repeat(w.starts, size) + place]
                              == self.data[np.repeat(w.starts[one][which], size) + place]).all()])
        if same.all():
            return which
        body, seen = self.data.tobytes(), {}
        return np.array([seen.setdefault(body[a:b], len(seen)) for a, b in zip(w.starts.tolist(), w.ends.tolist(), strict=True)])


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Runs]]:
    """(pointers, runs) of slices of batches (pointer, lang, text)."""
    for b in batches:
        texts = column(b.column(2))
        for lo, hi in slices(texts):
            yield b.column(0).slice(lo, hi - lo), Runs(texts.slice(lo, hi - lo), b.column(1).slice(lo, hi - lo))


def _slots(fingerprints: np.ndarray, bits: int) -> np.ndarray:
    return (fingerprints >> np.uint64(64 - bits)).astype(np.int64)


def _bitmap(rows: DataFrame, bits: int, least: int) -> np.ndarray:
    """Bits of the slots whose counts reach ``least``: rows of (block of 2**16 slots, slots in
    it, counts), added block by block in a stream. The driver gets 2**bits bits at most."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for block, slot, count in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block not in sums:
                    sums[block] = np.zeros(1 << 16, np.int64)
                sums[block][np.frombuffer(slot, "<u2")] += np.frombuffer(count, "<u2")
        for block, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], ["block", "bits"])

    out = np.zeros((max(1, 1 << (bits - 16)), 1 << 13), np.uint8)
    for r in rows.repartition("block").mapInArrow(add, "block int, bits binary").collect():
        out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _has(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 > 0


def _combined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(parts), return_counts=True)


def _slot_counts(bits: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0

        def out() -> pa.RecordBatch:
            slots, counts = _combined(held)
            counts = np.minimum(counts, least).astype("<u2")
            blocks, first = np.unique(slots >> 16, return_index=True)
            ends = [*first[1:].tolist(), len(slots)]
            low = (slots & 0xFFFF).astype("<u2")
            return pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array([low[a:b].tobytes() for a, b in zip(first.tolist(), ends, strict=True)], pa.binary()),
                 pa.array([counts[a:b].tobytes() for a, b in zip(first.tolist(), ends, strict=True)], pa.binary())], ["block", "slots", "counts"])

        for _, runs in _run_batches(batches):
            for n in (1, 2):
                held.append(_slots(runs.fingerprints(runs.places(n), n), bits))
                many += len(held[-1])
            if many > HELD:
                yield out()
                held, many = [], 0
        if many:
            yield out()

    return run


def _alive(runs: Runs, bitmap: np.ndarray, bits: int, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, places, fingerprints) of runs all of whose words or pairs lie in slots that are frequent."""
    w = len(runs.words)
    at = runs.places(1)
    fp = runs.fingerprints(at, 1)
    ok = _has(bitmap, _slots(fp, bits))
    yield 1, at[ok], fp[ok]
    alive = np.zeros(w, bool)
    at = runs.places(2)
    fp = runs.fingerprints(at, 2)
    ok = _has(bitmap, _slots(fp, bits))
    alive[at[ok]] = True
    for n in range(2, longest + 1):
        ok = np.ones(max(0, w - n + 1), bool)
        for j in range(n - 1):
            ok &= alive[j:j + len(ok)]
        at = np.flatnonzero(ok)
        yield n, at, runs.fingerprints(at, n)


class Counted:
    """Counts by (fingerprint, checksum), each with the least two of its texts: rows (fp, check, n, text),
    two a key at most, all of the key's count on the first."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.many = 0

    def add(self, fp: np.ndarray, check: np.ndarray, n: np.ndarray, text: np.ndarray) -> None:
        self.parts.append((fp, check, n, text))
        self.many += len(fp)

    def combine(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        fp, check, n, text = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((text, check, fp))
        fp, check, n, text = fp[order], check[order], n[order], text[order]
        key = np.append(True, (np.diff(fp) != 0) | (np.diff(check) != 0))
        new = np.flatnonzero(np.append(True, np.diff(text) != 0) | key)           # texts of a key
        start = np.flatnonzero(key)
        total = np.zeros(len(fp), np.int64)
        total[start] = np.add.reduceat(n, start)
        of_key = np.cumsum(key[new]) - 1
        place = np.arange(len(new)) - np.flatnonzero(key[new])[of_key]
        keep = new[place < 2]
        self.parts = [(fp[keep], check[keep], total[keep], text[keep])]
        self.many = len(keep)
        return self.parts[0]


def _fingerprint_counts(bitmap, bits: int, longest: int, deal: int):
    """Rows (block, data): counts of one of ``deal`` ranges of fingerprints, packed column by column;
    and under block -1 the number of words of each language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, held, total = bitmap.value, Counted(), {}

        def out() -> pa.RecordBatch:
            fp, check, n, text = held.parts[0]
            block = ((fp >> np.uint64(32)) * np.uint64(deal)) >> np.uint64(32)
            first = np.flatnonzero(np.append(True, np.diff(block) != 0)).tolist()
            data = [b"".join((fp[x:y].tobytes(), text[x:y].tobytes(), check[x:y].tobytes(), n[x:y].astype("<u4").tobytes()))
                    for x, y in zip(first, [*first[1:], len(fp)], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(block[first].astype(np.int32)), pa.array(data, pa.binary())], ["block", "data"])

        for places, runs in _run_batches(batches):
            for k, c in enumerate(np.bincount(runs.lang, minlength=len(runs.langs)).tolist()):
                total[runs.langs[k]] = total.get(runs.langs[k], 0) + c
            place = places.to_numpy()
            for n, at, fp in _alive(runs, filter_, bits, longest):
                if len(at):
                    held.add(fp, runs.checks(at, n), np.ones(len(at), np.int64), place[runs.words.rows[at]])
            if held.many > HELD:
                held.combine()
                if held.many > HELD // 2:
                    yield out()
                    held = Counted()
        if held.many:
            held.combine()
            yield out()
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1] * len(total), pa.int32()), pa.array([c.to_bytes(8, "little") + x.encode() for x, c in total.items()], pa.binary())],
                ["block", "data"])

    return run


def _counts(least: int):
    """Rows (fp, check, n, first, second) of the keys that occur ``least`` times or more, from packed
    rows; and (lang, n). A partition's keys are held, its rows are not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, limit, total = Counted(), HELD, {}
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if block < 0:
                    total[data[8:]] = total.get(data[8:], 0) + int.from_bytes(data[:8], "little")
                    continue
                k = len(data) // 24
                held.add(np.frombuffer(data, "<u8", k), np.frombuffer(data, "<i4", k, 16 * k),
                         np.frombuffer(data, "<u4", k, 20 * k).astype(np.int64), np.frombuffer(data, "<i8", k, 8 * k))
                if held.many > limit:
                    held.combine()
                    limit = max(HELD, 2 * held.many)
        if held.many:
            fp, check, n, text = held.combine()
            one = np.flatnonzero(n >= least)
            second = text[np.where((np.append(n, 1)[one + 1] == 0), one + 1, one)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp[one].view(np.int64)), pa.array(check[one], pa.int32()), pa.array(n[one]), pa.array(text[one]), pa.array(second),
                 pa.nulls(len(one), pa.string())], _COUNTED)
        if total:
            none = pa.nulls(len(total), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, pa.nulls(len(total), pa.int32()), pa.array(total.values(), pa.int64()), none, none,
                 pa.array([x.decode() for x in total], pa.string())], _COUNTED)

    return run


_COUNTED = ["fp", "check", "n", "first", "second", "lang"]


def _cut_out(longest: int):
    """(lang, n, phrase, fp, check) of what the fingerprints of rows (lang, text, array of (fp, check)) stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, texts, lists = b.column(0), column(b.column(1)), b.column(2)
            for lo, hi in slices(texts):
                runs = Runs(texts.slice(lo, hi - lo), langs.slice(lo, hi - lo))
                own = lists.slice(lo, hi - lo)
                fps, checks = (own.flatten().field(k).to_numpy() for k in (0, 1))
                row = np.repeat(np.arange(hi - lo), np.diff(own.offsets.to_numpy()))
                wanted = np.stack([row, fps, checks], axis=1)
                body, w, out = runs.data.tobytes(), runs.words, []
                for n in range(1, longest + 1):
                    at = runs.places(n)
                    fp, check = runs.fingerprints(at, n).view(np.int64), runs.checks(at, n)
                    hit = np.flatnonzero(np.isin(fp, fps))
                    mine = np.unique(np.stack([w.rows[at[hit]], fp[hit], check[hit]], axis=1), axis=0, return_index=True)
                    both = np.concatenate([mine[0], np.unique(wanted, axis=0)])
                    _, one, seen = np.unique(both, axis=0, return_index=True, return_counts=True)
                    for k in hit[mine[1][one[(seen > 1) & (one < len(mine[0]))]]].tolist():
                        i = int(at[k])
                        phrase = b" ".join(body[x:y] for x, y in zip(w.starts[i:i + n].tolist(), w.ends[i:i + n].tolist(), strict=True))
                        out.append((runs.langs[runs.lang[i]], n, phrase.decode(), int(fp[k]), int(check[k])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True) if out else [()] * 5, [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32()], strict=True)],
                    ["lang", "n", "phrase", "fp", "check"])

    return run


def _phrases(bitmap, bits: int, chosen_fps, chosen_bits: int, longest: int):
    """Phrases whose fingerprint's slot is chosen, each occurrence verified word by word: (lang, n, phrase, count, fp)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, chosen = bitmap.value, chosen_fps.value
        held: dict[tuple[str, int, bytes], list[int]] = {}

        def out() -> pa.RecordBatch:
            langs, ns, phrases = zip(*held, strict=True)
            counts, fps = zip(*held.values(), strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(ns, pa.int32()), pa.array(phrases, pa.binary()).cast(pa.string()),
                 pa.array(counts, pa.int64()), pa.array(fps, pa.int64())], ["lang", "n", "phrase", "count", "fp"])

        for _, runs in _run_batches(batches):
            if not len(runs.words):
                continue
            ids, body = runs.word_ids(), runs.data.tobytes()
            starts, ends = runs.words.starts, runs.words.ends
            #: single blank behind the word, so that the text between words is the phrase's own
            plain = np.zeros(len(ids), bool)
            plain[:-1] = (starts[1:] == ends[:-1] + 1) & (runs.data[np.minimum(ends[:-1], len(runs.data) - 1)] == 0x20)
            for n, at, fp in _alive(runs, filter_, bits, longest):
                ok = _has(chosen, _slots(fp, chosen_bits))
                at, fp = at[ok], fp[ok]
                while len(at):                              # once, unless fingerprints are wrong
                    keys, one, which, counts = np.unique(fp, return_index=True, return_inverse=True, return_counts=True)
                    stand = at[one][which]
                    same = runs.lang[at] == runs.lang[stand]
                    for j in range(n):
                        same &= ids[at + j] == ids[stand + j]
                    counts = counts if same.all() else np.bincount(which[same], minlength=len(one))
                    place = at[one]
                    direct = np.ones(len(place), bool)
                    for j in range(n - 1):
                        direct &= plain[place + j]
                    for p, f, c, d, a, b, la in zip(place.tolist(), keys.view(np.int64).tolist(), counts.tolist(), direct.tolist(), starts[place].tolist(),
                                                 ends[place + n - 1].tolist(), runs.lang[place].tolist(), strict=True):
                        phrase = body[a:b] if d else b" ".join(body[starts[p + j]:ends[p + j]] for j in range(n))
                        held.setdefault((runs.langs[la], n, phrase), [0, f])[0] += c
                    at, fp = at[~same], fp[~same]
            if len(held) > STRINGS:
                yield out()
                held = {}
        if held:
            yield out()

    return run


def frequent_phrases(df: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                     bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): (lang, n, phrase, count) of every phrase of 1 to ``longest`` words that occurs ``least``
    times or more; and (lang, n), the number of words of each language."""
    if not 1 <= longest < 1 << LENGTH_BITS:
        raise ValueError(f"longest must be from 1 to {(1 << LENGTH_BITS) - 1}")
    spark = df.sparkSession
    work = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    work = work.select(F.xxhash64("lang", "text").alias("place"), "lang", "text")
    if bits is None:                     # about one slot for 32 bytes of text, within bounds
        size = work.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        bits = min(MOST_BITS, max(16, (size // 32).bit_length()))
    few = min(least, 0xFFFF)
    slots = work.mapInArrow(_slot_counts(bits, few), "block int, slots binary, counts binary")
    bitmap = spark.sparkContext.broadcast(_bitmap(slots, bits, few))
    packed = work.mapInArrow(_fingerprint_counts(bitmap, bits, longest, blocks(spark)), "block int, data binary")
    counted = written(packed.repartition("block").mapInArrow(
        _counts(least), "fp long, check int, n long, first long, second long, lang string"), "phrase-fingerprints")
    totals = counted.where("lang IS NOT NULL").select("lang", "n")
    chosen = counted.where("lang IS NULL")

    ends = chosen.select(F.explode(F.array("first", "second")).alias("place"), "fp", "check")
    lists = written(ends.groupBy("place").agg(F.collect_set(F.struct("fp", "check")).alias("wanted")), "phrase-pointers")
    pointed = work.join(small(lists.select("place"), 16), "place", "left_semi").groupBy("place").agg(
        F.first("lang").alias("lang"), F.first("text").alias("text"))
    cut = pointed.join(lists, "place").select("lang", "text", "wanted").mapInArrow(
        _cut_out(longest), "lang string, n int, phrase string, fp long, check int")
    cut = written(cut.distinct(), "phrase-texts")
    unlike = cut.groupBy("fp", "check").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("fp", "check")
    unlike = written(unlike, "phrase-collisions")
    wrong = unlike.count()
    phrases = (cut.join(unlike, ["fp", "check"], "left_anti") if wrong else cut).join(
        chosen.select("fp", "check", F.col("n").alias("count")), ["fp", "check"]).select("lang", "n", "phrase", "count")
    if wrong:
        phrases = phrases.unionByName(_recount(work, unlike, bitmap, bits, longest).where(F.col("count") >= least))
    return written(phrases, "phrases"), totals


def _recount(work: DataFrame, unlike: DataFrame, bitmap, bits: int, longest: int) -> DataFrame:
    """Exact (lang, n, phrase, count) of the phrases that have the fingerprints of ``unlike``."""
    wide = min(MOST_BITS, max(16, (512 * unlike.count()).bit_length()))
    one = np.array([1], "<u2").tobytes()

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = np.unique(_slots(b.column(0).to_numpy().view(np.uint64), wide))
            blocks, first = np.unique(slot >> 16, return_index=True)
            low = (slot & 0xFFFF).astype("<u2")
            ends = [*first[1:].tolist(), len(slot)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array([low[x:y].tobytes() for x, y in zip(first.tolist(), ends, strict=True)], pa.binary()),
                 pa.array([one * (y - x) for x, y in zip(first.tolist(), ends, strict=True)], pa.binary())], ["block", "slots", "counts"])

    rows = unlike.select("fp").mapInArrow(marks, "block int, slots binary, counts binary")
    chosen = work.sparkSession.sparkContext.broadcast(_bitmap(rows, wide, 1))
    found = work.mapInArrow(_phrases(bitmap, bits, chosen, wide, longest), "lang string, n int, phrase string, count long, fp long")
    found = found.join(unlike.select("fp").distinct(), "fp", "left_semi")
    return found.groupBy("lang", "n", "phrase").agg(F.sum("count").alias("count"))


def collocations(df: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST,
                 longest: int = LONGEST, top: int = TOP, bits: int | None = None) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language (see the module): lang, rank, phrase,
    a, l, r, n, score."""
    phrases, totals = frequent_phrases(df, text=text, lang=lang, least=least, longest=longest, bits=bits)
    counts = phrases.select("lang", "phrase", F.col("count").alias("f"))
    long = phrases.where("n > 1").withColumn("words", F.split("phrase", " "))
    inside = long.where("n > 2").select("lang", F.col("count").alias("longer"), F.explode(F.array(
        F.array_join(F.expr("slice(words, 1, n - 1)"), " "), F.array_join(F.expr("slice(words, 2, n - 1)"), " "))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    cuts = long.select("lang", "phrase", F.col("count").alias("a"), "words", F.col("n").alias("size"),
                       F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.expr("slice(words, 1, k)"), " ").alias("left"),
                       F.array_join(F.expr("slice(words, k + 1, size - k)"), " ").alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang").withColumn("score", F.expr(         # 38 digits hold both products
        "(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0)))"
        " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"))
    best = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"),
                                              F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    kept = best.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


ORACLE = """
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS row,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, row, generate_subscripts(p, 1) AS piece, unnest(p) AS text
           FROM (SELECT lang, row, string_split_regex(text, '[.,;:!?\x0A-\x0D]') AS p FROM docs)),
words AS (SELECT lang, row, piece, regexp_extract_all(text, '[^\x20\x09]+') AS w FROM pieces),
runs AS (SELECT lang, size, array_to_string(w[b:b + size - 1], ' ') AS phrase
         FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS b
               FROM words, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
cuts AS (SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, t.n,
                (1000::HUGEINT * c.a * t.n // (l.f::HUGEINT * r.f))::BIGINT AS score
         FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
         JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
         JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
         JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_runs AS (SELECT DISTINCT lang, a AS longer, array_to_string(w[s:s + m - 1], ' ') AS phrase
               FROM (SELECT *, unnest(range(1, size - m + 2)) AS s FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates))),
gone AS (SELECT DISTINCT b.lang, b.phrase FROM best b JOIN inner_runs i ON i.lang = b.lang AND i.phrase = b.phrase
         WHERE 100 * i.longer >= 100 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM best ANTI JOIN gone USING (lang, phrase)) WHERE rank <= 2000
"""
