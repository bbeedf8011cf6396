"""Mixing sources to target weights by Sainte-Laguë apportionment.

Size is the number of words ``[^\\x20\\x09-\\x0D]+``. Sources by code point, NULL
last, weigh 5, 2, 1, repeating, and share ``share`` (150 %) of all sizes; a target
stops at ``most`` (2) times its source's size and the excess is shared again by
weight until none is above.

Highest quotients target / (2 k + 1) give each source its integer quota of words.
They are taken in blocks of about ``block`` words; a source too small for 128 of them,
or with a target under 32, has smaller blocks of its own, and no other source's blocks
change with it. The quota, rounded to whole blocks, goes on: a source is dealt into
shards by a seeded hash of the id (a hot source into many, so none is a hot
group), and its blocks go to its shards the same way, by their sizes. A shard puts
its documents in seeded order, cuts them into equal blocks, takes every block
quota // blocks times and a seeded choice of them once more: no word is taken more
than twice. Everything follows from ids, sizes and the seed: reruns agree.

What reaches the driver is one row a source (weights are given by source). NULL and
empty texts have size 0 and take nothing: they are answered where they lie, in no
shard, so a shard of about 2^18 words has no more rows than words. Shards grow in
number, not in size; one task a source shares its blocks out, with a row a shard. Rows that repeat an id are documents of
their own, side by side in their shard. No rows: no rows. Ids may be NULL.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import cycle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import BROADCAST_BYTES, numbered, written
from .words import Words, column, mix, slices

WEIGHTS = (5, 2, 1)
SHARD_WORDS = 1 << 18


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Each source's target: its weight's part of ``share`` times all sizes, capped
    at ``most`` times its size, the excess shared again by weight."""
    size, w = np.asarray(sizes, float), np.asarray(weights, float)
    out, open_ = np.zeros(len(size)), np.ones(len(size), bool)
    left = share * size.sum()
    while open_.any() and left > 0:
        part = left * w / w[open_].sum()
        over = open_ & (part > most * size)
        if not over.any():
            out[open_] = part[open_]
            break
        out[over] = most * size[over]
        left -= out[over].sum()
        open_ &= ~over
    return out.tolist()


def apportion(weights: Sequence[float], seats: int, most: Sequence[int] | None = None) -> np.ndarray:
    """Sainte-Laguë: ``seats`` by highest quotients weight / (2 k + 1), none beyond
    its ``most``; of equal quotients, the earlier one."""
    w = np.asarray(weights, float)
    cap = np.asarray(most, np.int64) if most is not None else np.full(len(w), np.iinfo(np.int64).max)
    if not len(w) or w.sum() <= 0:
        return np.zeros(len(w), np.int64)
    q = np.minimum(np.floor(w * (seats / w.sum()) + 0.5).astype(np.int64), cap)   # seats of one divisor
    while q.sum() < seats and ((room := q < cap) & (w > 0)).any():
        q[np.argmax(np.where(room, w / (2 * q + 1), -1.0))] += 1
    while q.sum() > seats:
        q[len(q) - 1 - np.argmin(np.where(q > 0, w / np.maximum(2 * q - 1, 1), np.inf)[::-1])] -= 1
    return q


def seeded(values: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(values.astype(np.uint64) + mix(np.array([seed], np.uint64)))


def times_of_blocks(n: int, quota: int, seed: int) -> np.ndarray:
    """How often each of a shard's ``n`` blocks is taken."""
    out = np.full(n, quota // n, np.int64)
    extra = quota - int(out.sum())
    if extra:
        out[np.argsort(seeded(np.arange(n), seed), kind="stable")[:extra]] += 1
    return out


def sizes_of(df: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """The key columns and ``size``, the number of words of each row."""
    work = df.select(*keys, F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arr, size = column(b.column(len(keys))), np.zeros(b.num_rows, np.int64)
            for lo, hi in slices(arr):
                size[lo:hi] = np.diff(Words(arr.slice(lo, hi - lo)).bounds)
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keys))] + [pa.array(size)],
                                             [*keys, "size"])

    kinds = [f"`{k}` {work.schema[k].dataType.simpleString()}" for k in keys]
    return work.mapInArrow(run, ", ".join([*kinds, "size long"]))


def _shard(seed: int):
    """Takes a shard's quota of blocks; gives each document's spans and words taken."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        key = seeded(rows["mix"].to_numpy(), seed)
        rows = rows.iloc[np.lexsort((rows["row"].to_numpy(), key))]
        size = rows["size"].to_numpy()
        total, block, quota = int(size.sum()), int(rows["block"].iat[0]), int(rows["shard_quota"].iat[0])
        taken, spans = np.zeros(len(size), np.int64), [[] for _ in size]
        if total and quota:
            n = blocks_of(total, block)
            times = times_of_blocks(n, quota, seed ^ (int(rows["rank"].iat[0]) << 20) ^ int(rows["shard"].iat[0]))
            edges = np.arange(n + 1) * total // n
            upto = np.concatenate([[0], np.cumsum(np.diff(edges) * times)])
            end = np.cumsum(size)
            start = end - size

            def before(x):
                k = np.minimum(np.searchsorted(edges, x, "right") - 1, n - 1)
                return upto[k] + (x - edges[k]) * times[k], k

            (a, first), (b, last) = before(start), before(np.maximum(end - 1, start))
            taken = np.where(size > 0, before(end)[0] - a, 0)
            for i in np.flatnonzero(taken).tolist():
                own = spans[i]
                for k in range(first[i], last[i] + 1):
                    lo, hi = max(start[i], edges[k]) - start[i], min(end[i], edges[k + 1]) - start[i]
                    if times[k] and own and own[-1][2] == times[k] and own[-1][0] + own[-1][1] == lo:
                        own[-1][1] += int(hi - lo)
                    elif times[k] and hi > lo:
                        own.append([int(lo), int(hi - lo), int(times[k])])
        return pd.DataFrame({"row": rows["row"], "id": rows["id"], "size": size, "source_size": rows["source_size"],
                             "target": rows["target"], "taken": taken,
                             "spans": [[{"start": s, "length": n, "times": t} for s, n, t in own] for own in spans]})

    return run


def blocks_of(words: int, block: int) -> int:
    return max(1, round(words / block)) if words else 0


def block_of(words: int, target: float, block: int) -> int:
    """Block size of one source: it follows from the source alone."""
    return max(1, min(block, words // 128, int(target) // 32))


def block_quota(words: int, quota: int, block: int, most: int) -> int:
    """A source's quota of words in whole blocks."""
    n = blocks_of(words, block)
    return min(most * n, round(quota * n / words)) if words else 0


def mix_sources(df: DataFrame, *, text: str = "text", id: str = "doc_id", source: str = "source",
                weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 42,
                block: int = 1024, row: str | None = None) -> DataFrame:
    """One row per row of ``df``: ``row`` (a unique row number if the caller has one), ``id``,
    ``size``, ``source_size``, ``target``, ``taken`` and ``spans`` (start, length and
    times of the words taken)."""
    spark = df.sparkSession
    work = df.select((F.col(row) if row else F.lit(0)).cast("long").alias("row"), F.col(id).cast("long").alias("id"),
                     F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    sizes = written(sizes_of(work, "row", "id", "source"), "mix-sizes")
    found = sizes.groupBy("source").agg(F.sum("size").alias("n")).collect()            # one row a source
    found = sorted(((r["source"], r["n"]) for r in found), key=lambda r: (r[0] is None, r[0] or ""))
    wanted = targets([n for _, n in found], [w for w, _ in zip(cycle(weights), found)], share, most)
    shards = [max(1, n // SHARD_WORDS) for _, n in found]
    quota = apportion(wanted, round(sum(wanted)), [most * n for _, n in found])
    own = [block_of(n, t, block) for (_, n), t in zip(found, wanted, strict=True)]
    plan = spark.createDataFrame(
        [(s, k, n, float(t), block_quota(n, int(q), b, most), m, b) for k, ((s, n), t, q, m, b) in
         enumerate(zip(found, wanted, quota, shards, own, strict=True))],
        "name string, rank int, source_size long, target double, quota long, shards int, block long")
    if len(found) * 200 <= BROADCAST_BYTES:
        plan = F.broadcast(plan)
    planned = sizes.join(plan, F.col("source").eqNullSafe(F.col("name")))
    spans = "array<struct<start: long, length: long, times: int>>"
    none = planned.where("size = 0").select("row", "id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"),
                                            F.array().cast(spans).alias("spans"))
    rows = (planned.where("size > 0").withColumn("mix", F.xxhash64("id", "size"))
            .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "mix"), F.col("shards")).cast("int")))

    def share_out(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("shard")
        got = apportion(part["words"], int(part["quota"].iat[0]),
                        [most * blocks_of(n, int(part["block"].iat[0])) for n in part["words"]])
        return part[["rank", "shard"]].assign(shard_quota=got)

    quotas = (rows.groupBy("rank", "quota", "block", "shard").agg(F.sum("size").alias("words"))
              .groupBy("rank").applyInPandas(share_out, "rank int, shard int, shard_quota long"))
    return none.unionByName(rows.join(quotas, ["rank", "shard"]).groupBy("rank", "shard").applyInPandas(
        _shard(seed), f"row long, id long, size long, source_size long, target double, taken long, spans {spans}"))


def mixed_texts(df: DataFrame, **kw) -> DataFrame:
    """The mix itself: the rows of ``df`` with the text that is taken, a row for each
    time; words taken more often than others of their document make a row of their
    own. Other columns stay as they are."""
    spark = df.sparkSession
    columns = df.columns
    text = kw.get("text", "text")
    base = numbered(df, "__row", "mix-rows")
    spans = mix_sources(base, row="__row", **kw).where("taken > 0").select(F.col("row").alias("__row"), F.col("spans").alias("__spans"))
    work = base.join(spans, "__row").select(*columns, "__spans")
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arr, spans = column(b.column(at)), b.column(len(columns)).to_pylist()
            for lo, hi in slices(arr):
                w = Words(arr.slice(lo, hi - lo))
                texts, rows = [], []
                for i in range(hi - lo):
                    for turn in range(1, max(s["times"] for s in spans[lo + i]) + 1):
                        parts = []
                        for s in spans[lo + i]:
                            if s["times"] >= turn:
                                a = w.bounds[i] + s["start"]
                                parts.append(w.data[w.starts[a]:w.ends[a + s["length"] - 1]].tobytes().decode("utf-8", "replace"))
                        texts.append("\n".join(parts))
                        rows.append(lo + i)
                own = pa.RecordBatch.from_arrays([b.column(i) for i in range(len(columns))], columns).take(pa.array(rows, pa.int32()))
                yield own.set_column(at, columns[at], pa.array(texts, pa.string()))

    out = work.mapInArrow(run, work.select(*columns).schema)
    if "n_chars" in columns and text == "text":
        out = out.withColumn("n_chars", F.char_length(F.col(text)).cast(df.schema["n_chars"].dataType))
    return out


def mix_query(docs: DataFrame) -> DataFrame:
    return mix_sources(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
