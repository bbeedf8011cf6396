"""Fingerprints and exact dedup against direct computation."""
from __future__ import annotations

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from brickyard.llm import tables
from brickyard.llm.exact_dedup import Cuckoo, Index, exact_dedup
from brickyard.llm.fingerprints import Prefix, edited, fingerprints

from .conftest import bag

TEXT = st.text("abé ", max_size=60)


@settings(max_examples=150, deadline=None)
@given(TEXT, TEXT, st.data())
def test_spans_and_extensions(a, b, data):
    x, y = Prefix(a), Prefix(b)
    i, j = data.draw(st.integers(0, len(a))), data.draw(st.integers(0, len(b)))
    size = data.draw(st.integers(0, min(len(a) - i, len(b) - j)))
    assert x.same(i, y, j, size) == (a[i:i + size] == b[j:j + size])
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    assert x.extension(i, y, j) == n
    assert 0 <= x.likeness(y) <= 1 and (a != b or x.likeness(y) == 1)
    assert (x.fingerprint() == y.fingerprint()) == (a == b)


def test_likeness_follows_common_parts():
    a = "".join(chr(97 + i * i % 23) + chr(97 + i % 19) for i in range(600))
    b = a[:300] + "XX" + a[330:700] + "YY" + a[705:]
    assert Prefix(a).likeness(Prefix(b)) > 0.95
    assert Prefix(a).likeness(Prefix("1234567890" * 120)) < 0.05


def test_fingerprints_of_awkward_rows(docs, rows, monkeypatch):
    monkeypatch.setattr(tables, "blocks", lambda spark: 5)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    got = fingerprints(docs).collect()
    assert len(got) == len(rows)
    ids = [r[0] for r in order]
    after = defaultdict(list)
    for k, r in enumerate(order):
        after[r[0]].append((r[1] or "", order[(k + 1) % len(order)][1] or ""))
    for r in got:
        if ids.count(r["doc_id"]) == 1:
            text, following = after[r["doc_id"]][0]
            k = ids.index(r["doc_id"])
            if ids.count(ids[(k + 1) % len(ids)]) == 1:
                changed = edited(text, following)
                assert r["n_chars"] == len(text)
                assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
                assert r["fingerprint"] == Prefix(text).fingerprint()
                assert r["edited_fingerprint"] == Prefix(changed).fingerprint()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_fingerprints_of_no_rows_one_row_and_no_ids(spark, empty):
    assert fingerprints(empty).count() == 0
    one = fingerprints(spark.createDataFrame([(4, "alone")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"aloal").hexdigest()
    none = fingerprints(spark.createDataFrame([(None, "x"), (None, None)], "doc_id long, text string"))
    assert none.count() == 2


def folded(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def test_exact_dedup_of_awkward_rows(docs, rows):
    groups = defaultdict(list)
    for i, t, _, _ in rows:
        groups[folded(t)].append(i)
    want = []
    for text, ids in groups.items():
        top = max(ids, key=lambda i: (i is not None, i or 0))
        sha, done = hashlib.sha256(text.encode()).hexdigest(), False
        for i in ids:
            want.append((i, top, len(ids), i == top and not done, sha))
            done |= i == top
    assert bag(exact_dedup(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)


def test_exact_dedup_of_no_rows(empty):
    assert exact_dedup(empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 9)), max_size=300))
def test_index_keeps_the_largest_and_counts(adds):
    index, plain = Index(), {}
    for text, doc in adds:
        digest = hashlib.sha256(str(text).encode()).digest()
        index.add(digest, doc)
        best, n = plain.get(digest, (-1, 0))
        plain[digest] = (max(best, doc), n + 1)
    assert {e[0]: (e[1], e[2]) for e in index.entries()} == plain and index.live == len(plain)
    for digest in list(plain)[::2]:
        index.delete(digest)
    assert all((index.find(d) is None) == (k % 2 == 0) for k, d in enumerate(plain))


def test_filter_overflow_resizes_from_stored_keys():
    index = Index()
    index.filter = Cuckoo(2)
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(500)]
    for d in digests:
        index.add(d, 1)
    assert index.filter.mask > 1 and all(index.find(d) for d in digests)
