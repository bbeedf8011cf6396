"""Token counts by unigram segmentation over a trie of distinct pre-tokens.

A pre-token is a word (``[^\\x20\\x09-\\x0D]+``) behind the word-start mark. A
vocabulary piece of rank r (0 first) has the unigram log score ``-ln(r + 2)``:
the file orders pieces by frequency, so this is the Zipf estimate; tokenizers
are not trained here. The token count of a pre-token is the number of pieces in
its best-scoring segmentation; of equal scores, the one whose last piece is
longest. A character that no piece covers costs one token per UTF-8 byte.

Method: the distinct pre-tokens of a slice of rows are inserted into a trie, and
the forward score of a node (best segmentation of the prefix it stands for) is
computed once; all pre-tokens that share the prefix use it. The count at a
pre-token's last node is its token count, stored by the pre-token's hash, so
that each goes through a trie once a task. The store has a bound, at which it is
started afresh: results do not depend on it.

Scan, map, done: nothing is shuffled, so no word, source or group of copies can
gather in one task. NULL and empty texts, and texts of white space, have 0
tokens. Repeated rows are counted like any other; every row gives one row.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, column, slices

MARK = "▁"
CHARS = 1 << 21                  # more than there are code points
MAX_STORED = 4_000_000           # 12 bytes each


@lru_cache(maxsize=2)
def piece_scores(model_path: str) -> dict[str, float]:
    """Unigram log score by piece, from a sentencepiece model file's order of pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    usable = [i for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {sp.id_to_piece(i): -math.log(rank + 2) for rank, i in enumerate(usable)}


class Pieces:
    """The pieces' own prefix tree as arrays: a step is keyed by (place, character)."""

    def __init__(self, scores: dict[str, float]):
        step: dict[int, int] = {}
        ends = [np.nan]
        for piece in sorted(scores):
            place = 0
            for ch in piece:
                key = place * CHARS + ord(ch)
                place = step.setdefault(key, len(ends))
                if place == len(ends):
                    ends.append(np.nan)
            ends[place] = scores[piece]
        self.keys = np.array(sorted(step), np.int64)
        self.places = np.array([step[k] for k in self.keys.tolist()], np.int64)
        self.ends = np.array(ends)
        self.byte_score = min(scores.values(), default=0.0) - 10.0

    def step(self, place: np.ndarray, ch: np.ndarray) -> np.ndarray:
        """The place one character on, -1 where no piece goes on."""
        if not len(self.keys):
            return np.full(len(place), -1)
        key = place * CHARS + ch
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.places[at], -1)


def trie_counts(tokens: list[str], pieces: Pieces) -> np.ndarray:
    """Insert ascending distinct ``tokens`` in a trie, level by level; token count of each.

    A level's nodes are the distinct prefixes of its length. Each node gets its
    forward score once, from the open pieces of the node above: those that started
    at or above that node and may go on (place in the vocabulary's tree, score and
    tokens before the piece; longest first)."""
    size = np.array([len(t) for t in tokens], np.int64)
    chars = np.frombuffer("".join(tokens).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    first = np.cumsum(size) - size
    out = np.zeros(len(tokens), np.int64)
    alive = np.flatnonzero(size > 0)
    node = np.zeros(len(alive), np.int64)                      # each token's node in the level above
    best, used = np.zeros(1), np.zeros(1, np.int64)
    open_at, open_place = np.array([0, 1]), np.zeros(1, np.int64)   # open pieces by node, as offsets
    open_score, open_used = np.zeros(1), np.zeros(1, np.int64)
    depth = 0
    while len(alive):
        ch = chars[first[alive] + depth]
        new = np.ones(len(alive), bool)
        new[1:] = (node[1:] != node[:-1]) | (ch[1:] != ch[:-1])
        above, ch = node[new], ch[new]
        node = np.cumsum(new) - 1
        # the node above's open pieces, one character on
        many = np.diff(open_at)[above]
        own = np.repeat(np.arange(len(above)), many)
        src = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many) + open_at[above][own]
        place = pieces.step(open_place[src], ch[own])
        going = place >= 0
        own, src, place = own[going], src[going], place[going]
        # forward score: the best piece that ends here, else bytes
        wide = 1 + (ch >= 0x80) + (ch >= 0x800) + (ch >= 0x10000)
        score, count = best[above] + wide * pieces.byte_score, used[above] + wide
        ending = pieces.ends[place]
        total = open_score[src] + ending
        done = ~np.isnan(total)
        np.fmax.at(score, own[done], total[done])
        hit = np.flatnonzero(done & (total == score[own]))[::-1]   # longest last, so that it stays
        count[own[hit]] = open_used[src[hit]] + 1
        # pieces that may start below this node
        nodes = len(above)
        order = np.argsort(np.concatenate([own, np.arange(nodes)]), kind="stable")
        open_place = np.concatenate([place, np.zeros(nodes, np.int64)])[order]
        open_score = np.concatenate([open_score[src], score])[order]
        open_used = np.concatenate([open_used[src], count])[order]
        open_at = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=nodes) + 1)])
        best, used = score, count
        depth += 1
        last = size[alive] == depth
        out[alive[last]] = used[node[last]]
        alive, node = alive[~last], node[~last]
    return out


class Terminals:
    """Token counts of the pre-tokens seen so far, by hash (two sorted arrays)."""

    def __init__(self, pieces: Pieces, most: int = MAX_STORED):
        self.pieces, self.most = pieces, most
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def of(self, words: Words) -> np.ndarray:
        """The token count of every word of a slice."""
        keys, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        found = np.zeros(len(keys), np.int32)
        found[known] = self.counts[at[known]]
        new = np.flatnonzero(~known)
        texts = [words.text(i) for i in first[new].tolist()]
        order = sorted(range(len(texts)), key=texts.__getitem__)
        found[new[order]] = trie_counts([MARK + texts[i] for i in order], self.pieces)
        if len(self.keys) + len(new) > self.most:
            self.keys, self.counts = keys, found
        elif len(new):
            place = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, place, keys[new])
            self.counts = np.insert(self.counts, place, found[new])
        return found[which]


def counts_of(arr: pa.Array, terminals: Terminals) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and words of each row of a string column."""
    tokens, n_words = np.zeros(len(arr), np.int64), np.zeros(len(arr), np.int64)
    for a, b in slices(arr):
        w = Words(arr.slice(a, b - a))
        if len(w):
            tokens[a:b] = np.bincount(w.rows, terminals.of(w), b - a).astype(np.int64)
            n_words[a:b] = np.diff(w.bounds)
    return tokens, n_words


def token_counts(df: DataFrame, model_path: str, *, text: str = "text",
                 id: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: the id column, ``n_words`` and ``n_tokens``."""
    work = df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terminals = Terminals(Pieces(piece_scores(model_path)))
        for batch in batches:
            tokens, n_words = counts_of(column(batch.column(1)), terminals)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(tokens)], ["id", "n_words", "n_tokens"])

    out = work.mapInArrow(run, f"id {work.schema['id'].dataType.simpleString()}, n_words long, n_tokens long")
    return out.withColumnRenamed("id", id)
