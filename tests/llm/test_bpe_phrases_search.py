"""Byte-level BPE against the tokenizer library, phrases and search against brute force."""
from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from brickyard.llm import byte_bpe, phrases, search, words
from brickyard.llm.queries import QUERIES

from .conftest import bag, prose

TINY = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="session")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="session")
def coder():
    return byte_bpe.Coder(RANKS, byte_bpe.class_runs())


def same_ids(coder, library, texts):
    ids, starts, many = coder.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(many)
    for text, a, b in zip(texts, (ends - many).tolist(), ends.tolist(), strict=True):
        want = library.encode_ordinary(text)
        assert ids[a:b].tolist() == want, text[:60]
        assert coder.decode(ids[a:b]).tobytes() == text.encode()
        assert starts[a:b].tolist() == np.cumsum([0, *[len(library.decode_single_token_bytes(i)) for i in want]])[:-1].tolist()


PARTS = st.sampled_from(["a", "The", "s", "t", "re", "ve", "r", "v", "l", "ll", "d", "m", "'", "''", "'s", "'re", "'ll", " ", "  ", "\n", "\t",
                         " ", " ", "\x1c", "7", "²", "Ⅷ", "!", "$$", "é", "漢", "ſ", "😀", "ᲊ", "<|endoftext|>", "\x00"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=25).map("".join), max_size=4))
def test_ids_are_the_library_s(coder, library, texts):
    same_ids(coder, library, texts)


def test_long_words_and_runs(coder, library):
    rng = random.Random(3)
    same_ids(coder, library, ["x" * 5000, "ab" * 20000, " " * 3000, "'" * 99, "", "\n" * 70 + "a",
                              "".join(rng.choice("abcdefgh") for _ in range(60000)), "1" * 47, "z" * 48, "q" * 49])


def test_kept_slices_are_bounded(library):
    own = byte_bpe.Coder(RANKS, byte_bpe.class_runs(), most=50)
    for k in range(6):
        same_ids(own, library, [prose(random.Random(k), 40)])
        assert len(own.keys) <= 60


def test_scan_is_the_automaton_read_in_order():
    rng, own = np.random.default_rng(0), byte_bpe.automaton()
    for n in (1, 63, 64, 65, 5000):
        kinds = rng.integers(0, 10, n)
        firsts = np.unique(np.append(0, rng.integers(0, n, n // 50)))
        state, want = byte_bpe.FRESH, set()
        for i, k in enumerate(kinds.tolist()):
            if i in firsts:
                if state in (byte_bpe.QUOTE_RV, byte_bpe.QUOTE_L):
                    want.add(i - 1)
                state, flags = byte_bpe._read(byte_bpe.FRESH, k)[0], byte_bpe.HERE
            else:
                state, flags = byte_bpe._read(state, k)
            want |= {i} if flags & byte_bpe.HERE else set()
            want |= {i - 1} if flags & byte_bpe.BEFORE else set()
        if state in (byte_bpe.QUOTE_RV, byte_bpe.QUOTE_L):
            want.add(n - 1)
        assert own.starts(kinds, firsts).tolist() == sorted(want)


def test_bpe_of_awkward_rows(spark, docs, rows, empty, library):
    want = []
    for i, t, _, _ in rows:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = byte_bpe.round_trip(docs, RANKS)
    assert bag(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert byte_bpe.round_trip(empty, RANKS).collect() == []
    named = spark.createDataFrame([("a", "it's", 1, 2)], "key string, ids string, n_tokens int, decoded int")
    out = byte_bpe.encode(named, RANKS, text="ids", id="key").first()
    assert (out["key"], out["n_tokens"], np.frombuffer(out["starts"], "<u4").tolist()) == ("a", 2, [0, 2])
    back = byte_bpe.decode(spark.createDataFrame([(1, None), (2, bytes(out["ids"]))], "k int, ids binary"), RANKS)
    assert bag(back, "k", "decoded") == [(1, b""), (2, b"it's")]
    with pytest.raises(ValueError):
        byte_bpe.decode(named, RANKS, ids="ids")


def test_bpe_query_holds_every_text(spark, library):
    got = {r["doc_id"]: r for r in QUERIES["op11_byte_bpe"](spark, TINY).collect()}
    rows = spark.read.parquet(f"{TINY}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = np.array(library.encode_ordinary(r["text"]), "<u4").tobytes()
        own = got[r["doc_id"]]
        assert (own["n_tokens"], own["ids_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert own["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


# --- phrases

def brute_counts(rows, longest=5):
    counts, total = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(AZ)):
            own = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(own)
            for n in range(1, longest + 1):
                for i in range(len(own) - n + 1):
                    counts[lang, tuple(own[i:i + n])] += 1
    return counts, total


def brute_collocations(rows, least, longest=5, top=2000):
    counts, total = brute_counts(rows, longest)
    common = {k: c for k, c in counts.items() if c >= least}
    by_lang = defaultdict(list)
    for (lang, p), a in common.items():
        if len(p) < 2 or any(c >= a and la == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
                             for (la, q), c in common.items()):
            continue
        cuts = [(1000 * a * total[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        by_lang[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, total[lang], -score) for lang, own in by_lang.items()
                  for rank, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1))


def phrase_rows():
    rng = random.Random(9)
    stems = [prose(rng, 1) for _ in range(25)]
    out = [(None, "Ünder the, the  sea\tthe sea", None, "a"), (1, None, "en", None), (2, "", "und", None), (3, "the sea. The SEA;the sea", "und", None)]
    fixed = " ".join(stems[:5])
    for i in range(60):
        own = [rng.choice(stems) for _ in range(30)]
        own[10:10] = [fixed.upper() if i % 3 else fixed, rng.choice([",", ".", "\n", "\t", ""])]
        out.append((i % 50, " ".join(own), rng.choice(["en", "de", "en", None, "x y"]), "a"))
    return out


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("least, bits, top", [(2, None, 2000), (3, 16, 7), (12, 17, 2000)])
def test_collocations_against_brute_force(spark, least, bits, top):
    rows = phrase_rows()
    df = spark.createDataFrame([(*r, "1", "2") for r in rows], "doc_id long, text string, lang string, source string, n string, phrase string").repartition(5)
    got = phrases.collocations(df, least=least, bits=bits, top=top)
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, least, top=top)


def test_collocations_of_awkward_rows(docs, rows, empty):
    assert phrases.collocations(empty).collect() == []
    assert phrases.collocations(docs, least=10**6).collect() == []
    got = phrases.collocations(docs, least=6, bits=18)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, 6)


@pytest.mark.parametrize("mask", [0x3, 0xFF, 0xFFF, (1 << 64) - 1])
def test_colliding_fingerprints_are_told_apart(monkeypatch, mask):
    full = words.mix
    monkeypatch.setattr(phrases, "mix", lambda x: full(x) & np.uint64(mask))
    monkeypatch.setattr(words, "mix", lambda x: full(x) & np.uint64(mask))
    rows = phrase_rows()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array([r[2] or "und" for r in rows]),
                                        pa.array([r[1] for r in rows], pa.string())], ["id", "lang", "text"])
    every = SimpleNamespace(value=np.full(1 << 13, 255, np.uint8))
    got = Counter()
    for out in phrases._phrases(every, 16, every, 16, 5)(iter([batch])):
        for r in out.to_pylist():
            got[r["lang"], tuple(r["phrase"].split(" "))] += r["count"]
    assert got == brute_counts(rows)[0]


def test_phrases_that_share_a_fingerprint_are_counted_again(spark, monkeypatch):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    right, _ = phrases.frequent_phrases(df, least=4)
    keep = phrases.written

    def doubted(frame, label):                  # every second fingerprint is taken for one of two phrases
        return keep(texts.where("fp % 2 = 0").select("fp", "check") if label == "phrase-collisions" else frame, label)

    def noted(frame, label):
        nonlocal texts
        out = doubted(frame, label)
        texts = out if label == "phrase-texts" else texts
        return out

    texts = None
    monkeypatch.setattr(phrases, "written", noted)
    again, _ = phrases.frequent_phrases(df, least=4)
    assert texts.where("fp % 2 = 0").count() > 50
    assert bag(again, "lang", "n", "phrase", "count") == bag(right, "lang", "n", "phrase", "count")
    counts, _ = brute_counts(rows)
    assert bag(right, "lang", "phrase", "count") == sorted(((la, " ".join(p), c) for (la, p), c in counts.items() if c >= 4), key=repr)


def test_counted_keeps_two_texts_a_key():
    rng = np.random.default_rng(1)
    own, want = phrases.Counted(), defaultdict(Counter)
    for _ in range(6):
        fp, check, text = rng.integers(0, 9, 40).astype(np.uint64), rng.integers(0, 2, 40).astype(np.int32), rng.integers(-5, 5, 40)
        own.add(fp, check, np.ones(40, np.int64), text)
        own.combine()
        for key in zip(fp.tolist(), check.tolist(), text.tolist(), strict=True):
            want[key[:2]][key[2]] += 1
    got = defaultdict(list)
    for f, c, n, t in zip(*(x.tolist() for x in own.combine()), strict=True):
        got[f, c].append((t, n))
    assert {k: ([t for t, _ in v], v[0][1]) for k, v in got.items()} == {k: (sorted(v)[:2], v.total()) for k, v in want.items()}
    assert all(n == 0 for v in got.values() for _, n in v[1:])


def test_checksums_and_fingerprints_follow_the_words():
    texts = pa.array(["a bc  d a", "A\tbc d, abc d", "bc d"])
    runs = phrases.Runs(texts, pa.array(["x", "x", "x"]))
    for n in (1, 2, 3):
        seen = defaultdict(set)
        for at in runs.places(n).tolist():
            own = tuple(runs.words.text(k).lower() for k in range(at, at + n))
            seen[own].add((int(runs.fingerprints(np.array([at]), n)[0]), int(runs.checks(np.array([at]), n)[0])))
        assert all(len(x) == 1 for x in seen.values()) and len({y for x in seen.values() for y in x}) == len(seen)
        assert len({y[1] for x in seen.values() for y in x}) == len(seen)


def test_slots_never_lose_a_frequent_phrase():
    rows = phrase_rows()
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(rows), pa.int64()), pa.array(["en"] * len(rows)),
                                        pa.array([r[1] for r in rows], pa.string())], ["id", "lang", "text"])
    total = np.zeros(1 << 18, np.int64)
    for out in phrases._slot_counts(18, 5)(iter([batch])):
        for r in out.to_pylist():
            total[(r["block"] << 16) + np.frombuffer(r["slots"], "<u2").astype(np.int64)] += np.frombuffer(r["counts"], "<u2")
    bitmap = SimpleNamespace(value=np.packbits(total >= 5))
    packed = list(phrases._fingerprint_counts(bitmap, 18, 5, 7)(iter([batch, batch.slice(0, 0)])))
    assert {r["block"] for b in packed for r in b.to_pylist()} <= set(range(-1, 7))
    seen = sum(r["lang"] is None for b in phrases._counts(5)(iter(packed)) for r in b.to_pylist())
    counts, _ = brute_counts([(0, r[1], "en", None) for r in rows])
    assert seen == sum(c >= 5 for c in counts.values())


# --- search

def brute_search(docs, items, top=50):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def terms(t):
        return cut.findall((t or "").translate(AZ))

    held = [(i, Counter(own)) for i, t in docs if (own := terms(t))]
    total, df = sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for item, own in wanted.items():
        scores = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * len(held) // total
            s = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in own if t in c)
            if s > 0:
                scores.append((-s, i is None, i if i is not None else 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def search_rows():
    rng = random.Random(4)
    vocabulary = [prose(rng, 1) for _ in range(40)] + ["é1", "漢字", "X9"]
    docs = [(i, "-".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12)))) for i in range(300)]
    docs += [(i, docs[i % 7][1].upper()) for i in range(300, 420)]                  # ties
    docs += [(None, docs[3][1]), (None, docs[3][1]), (5, docs[3][1]), (5, docs[3][1]), (600, None), (601, ""), (602, "!!"), (603, " ".join(vocabulary * 900))]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 9)))) for k in range(25)]
    items += [(3, "unheard " + vocabulary[0]), (None, vocabulary[1]), (90, None), (91, "..."), (92, "nowhere-at-all"), (93, docs[603 - 600][1])]
    return docs, items


@pytest.mark.parametrize("top, block_bytes", [(50, 1 << 20), (3, 600)])
def test_search_against_brute_force(spark, top, block_bytes):
    docs, items = search_rows()
    df = spark.createDataFrame([(*r, "1", 2) for r in docs], "doc_id long, text string, item string, n int").repartition(6)
    wanted = spark.createDataFrame([(*r, "1") for r in items], "item_id long, text string, term string")
    got = search.search(df, wanted, top=top, block_bytes=block_bytes)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert bag(got, "item_id", "rank", "doc_id", "score") == brute_search(docs, items, top)


def test_search_of_awkward_rows_and_string_items(spark, docs, rows, empty):
    items = spark.createDataFrame([("a", "another text under words"), ("b", "漢字 ONE")], "item_id string, text string")
    got = search.search(docs, items)
    assert bag(got, "item_id", "rank", "doc_id", "score") == brute_search([r[:2] for r in rows], [tuple(r) for r in items.collect()])
    assert search.search(empty, items).collect() == []
    assert search.search(docs, items.where("item_id = 'z'")).collect() == []


def test_vocabulary_tiles_keep_products_exact():
    weights = np.array([[3.0, 4.0, 5.0, 0.0, 9.0], [1.0, 1.0, 1.0, 1.0, 1.0]])
    tiles = search.vocabulary_tiles(weights, exact=10 * search.IMPACT)
    assert [x for t in tiles for x in range(t.start, t.stop)] == list(range(5))
    assert all(weights[:, t].sum(axis=1).max() < 10 for t in tiles) and len(tiles) == 3
    assert [(t.start, t.stop) for t in search.vocabulary_tiles(weights, most=2)] == [(0, 2), (2, 4), (4, 5)]
    assert search.vocabulary_tiles(np.zeros((2, 0))) == []


def test_lengths_beyond_64_bits():
    n = np.array([1, 10**9], np.int64)
    assert search._lengths(n, 10**11, 10**14).tolist() == [50 + 50 * 10**11 * int(x) // 10**14 for x in n]
