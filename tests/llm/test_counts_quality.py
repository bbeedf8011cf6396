"""Token counts against plain dynamic programming; the classifier on held-out rows."""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brickyard.llm import quality as q
from brickyard.llm.queries import op2_quality, tokenizer_file
from brickyard.llm.token_counts import MARK, Pieces, piece_scores, token_counts, trie_counts
from brickyard.llm.words import KINDS, Words, column, ngrams

from .conftest import WORD, bag

SMALL = "/root/testdata/sf0.01"
MODEL = tokenizer_file("piece_bpe_32k.model")


def plain_count(token: str, scores: dict[str, float], byte_score: float) -> int:
    best = [(0.0, 0)]
    for d in range(1, len(token) + 1):
        wide = len(token[d - 1].encode())
        score, used, ended = best[d - 1][0] + wide * byte_score, best[d - 1][1] + wide, False
        for start in range(d):                                   # longest piece first
            piece = scores.get(token[start:d])
            if piece is not None and (best[start][0] + piece > score or not ended and best[start][0] + piece == score):
                score, used, ended = best[start][0] + piece, best[start][1] + 1, True
        best.append((score, used))
    return best[-1][1]


def test_token_counts_match_plain_dynamic_programming(docs, rows):
    scores = piece_scores(MODEL)
    low = Pieces(scores).byte_score
    known: dict[str, int] = {}

    def count(text):
        words = WORD.findall(text or "")
        for w in words:
            if w not in known and len(w) < 100:
                known[w] = plain_count(MARK + w, scores, low)
        return None if any(len(w) >= 100 for w in words) else sum(known[w] for w in words)

    got = bag(token_counts(docs, MODEL), "doc_id", "n_words", "n_tokens")
    want = sorted(((i, len(WORD.findall(t or "")), count(t)) for i, t, _, _ in rows), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(w[2] is None or g[2] == w[2] for g, w in zip(got, want, strict=True))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abcé", min_size=1, max_size=9), max_size=30),
       st.dictionaries(st.text("abcé", min_size=1, max_size=4), st.floats(-9, -0.1), max_size=12))
def test_trie_levels_equal_plain_scores(tokens, scores):
    pieces = Pieces(scores)
    ordered = sorted(tokens)
    assert trie_counts(ordered, pieces).tolist() == [plain_count(t, scores, pieces.byte_score) for t in ordered]


def test_token_counts_of_no_rows(empty):
    assert token_counts(empty, MODEL).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("aB \t\né.", max_size=12) | st.none(), max_size=8))
def test_words_of_a_column(texts):
    w = Words(column(pa.array(texts, pa.string())), lower=True)
    want = [[x for x in WORD.findall(t or "")] for t in texts]
    got = [[w.text(i) for i in range(a, b)] for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
    assert got == want
    flat = ["".join(c.lower() if c.isascii() else c for c in x) for own in want for x in own]
    assert len(set(flat)) == len(set(w.hashes.tolist()))
    kinds = Words(column(pa.array(texts, pa.string())), classes=KINDS)
    assert sum(int(b - a) for a, b in zip(kinds.starts, kinds.ends, strict=True)) == sum(len(x.encode()) for own in want for x in own)


def test_ngram_hashes_follow_the_words():
    h = np.array([5, 6, 7, 5, 6, 7, 8], np.uint64)
    g = ngrams(h, 3)
    assert g[0] == g[3] and len(set(g.tolist())) == 4 and len(ngrams(h, 9)) == 0


@pytest.fixture(scope="module")
def scored(spark):
    return op2_quality(spark, SMALL).toPandas()


def test_quality_on_held_out_rows(spark, scored):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas().dropna(subset=["quality"])
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in scored.doc_id]).all()
    assert scored.score.between(0, 1).all() and (scored.predicted == (scored.score >= 0.5)).all()
    both = scored[scored.held_out].merge(labels, on="doc_id")
    assert (both.predicted == both.quality).mean() >= 0.93
    good, bad = both[both.quality == 1].score.to_numpy(), both[both.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() >= 0.97


def test_held_out_labels_change_nothing(spark, docs):
    labels = [(i, i % 2) for i in range(61)]
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    got = [bag(q.quality(docs, spark.createDataFrame(x, "doc_id long, quality int")), "doc_id", "score") for x in (labels, flipped)]
    assert got[0] == got[1]


def test_quality_of_awkward_rows_and_without_labels(spark, docs, empty, rows):
    none = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int")
    out = q.quality(docs, none)
    assert {r["score"] for r in out.collect()} == {0.5} and out.count() == len(rows)
    assert q.quality(empty, none).count() == 0


def test_ftrl_learns_a_separable_rule():
    model = q.Ftrl(bits=6)
    rng = np.random.default_rng(0)
    for _ in range(400):
        y = int(rng.integers(2))
        at = np.unique(rng.integers(0, 30, 5)) + 32 * y
        model.update(at, np.full(len(at), len(at) ** -0.5), y)
    w = model.weights()
    assert w[:30].max() < 0 < w[32:62].min()
