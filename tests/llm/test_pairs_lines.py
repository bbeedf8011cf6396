"""Jaccard join, substring dedup and line dedup against brute force."""
from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from brickyard.llm import jaccard_join
from brickyard.llm.components import components
from brickyard.llm.jaccard_join import jaccard_components
from brickyard.llm.line_dedup import line_dedup
from brickyard.llm.substring_dedup import substring_dedup

from .conftest import WORD, bag, prose
from .test_fingerprints_exact import folded


def shingles(text):
    w = WORD.findall(folded(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    """By place in ``rows``: the set's size and the least id reached."""
    sets = [shingles(t) for _, t, *_ in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    ids = defaultdict(list)
    for k, r in enumerate(rows):
        if r[0] is not None:
            ids[label[k]].append(r[0])
    return sorted(((r[0], len(sets[k]), min(ids[label[k]], default=None)) for k, r in enumerate(rows)), key=repr)


def near_rows():
    """Groups of near copies (chains of edits), exact copies, and shared passages."""
    rng = random.Random(11)
    out, passage = [], prose(rng, 40)
    for _ in range(4):
        words = prose(rng, rng.randint(60, 160)).split()
        for _ in range(rng.randint(3, 9)):
            words = list(words)
            words[rng.randrange(len(words))] = f"edit{rng.random()}"
            out.append(" ".join(words))
    out += [out[0], out[0].upper(), *[prose(rng, 50) + " " + passage for _ in range(6)], "a b", "A  b", "a", "", None]
    rng.shuffle(out)
    return [(k * 3 % 101, t) for k, t in enumerate(out)]


@pytest.mark.parametrize("options", [{}, {"short": 1}, {"short": 2, "often": 1, "split_at": 2}, {"common": 5, "often": 1}])
def test_jaccard_components(spark, options):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert bag(jaccard_components(df, **options), "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_jaccard_of_awkward_rows_and_none(docs, rows, empty):
    assert bag(jaccard_components(docs), "doc_id", "n_shingles", "component_id") == brute_components(rows)
    assert jaccard_components(empty).count() == 0


def test_jaccard_shingles_that_no_task_has_twice_are_common(spark, monkeypatch):
    """A passage of 30 documents, one a task, stays behind the prefixes: no long columns."""
    rng, long = random.Random(4), []
    passage = " ".join(f"shared{k}" for k in range(40))
    rows = [(k, " ".join(f"own{rng.random()}" for _ in range(60)) + " " + passage) for k in range(30)]
    rows += [(100, rows[7][1] + " more"), (101, passage)]

    def spied(df, label, real=jaccard_join.written):
        out = real(df, label)
        if label == "jaccard-cells":
            long.append(out.where("b IS NULL AND a <> 0").select("col", "a").collect())
        return out

    monkeypatch.setattr(jaccard_join, "written", spied)
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")
    assert bag(jaccard_components(df), "doc_id", "n_shingles", "component_id") == brute_components(rows)
    assert long == [[]]
    assert bag(jaccard_components(df, common=5), "doc_id", "n_shingles", "component_id") == brute_components(rows)
    assert long[1]


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_components_of_a_path_of_shuffled_ids(spark):
    ids = list(range(2000))
    random.Random(6).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long").coalesce(2)
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == dict.fromkeys(ids, 0)


def brute_substrings(rows, window=20):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    seen, out = set(), []
    for i, t, *_ in order:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            own = tuple(w[s:s + window])
            if own in seen:
                gone[s:s + window] = [True] * window
            seen.add(own)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("range_rows", [2, 1000])
def test_substrings_of_awkward_rows(docs, rows, range_rows):
    got = substring_dedup(docs, range_rows=range_rows)
    assert bag(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_substrings(rows)


def test_substrings_at_any_offset(spark):
    rng = random.Random(3)
    source = [prose(rng, 1) + str(i) for i in range(300)]
    rows = [(k, " ".join(source[a:a + rng.randint(15, 60)] + [f"own{k}"] + source[b:b + 25]))
            for k in range(40) for a, b in [(rng.randrange(250), rng.randrange(250))]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for range_rows in (3, 50):
        assert bag(substring_dedup(df, range_rows=range_rows), "doc_id", "n_words", "n_removed", "kept_sha256") == brute_substrings(rows)


def test_substrings_of_no_rows(empty):
    assert substring_dedup(empty).count() == 0


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1:] == b[k + 1:]
    a, b = sorted((a, b), key=len)
    return a[k:] == b[k + 1:]


def brute_lines(rows, min_edit=8):
    """(id, text without the dropped lines, lines, dropped), in the order of ``rows`` where ids repeat."""
    key = lambda i, k: (i if i is not None else 2**63, k)
    first: dict[str, tuple] = {}
    for k, (i, t, *_) in enumerate(rows):
        for at, line in enumerate((t or "").split("\n")):
            if line:
                first[line] = min(first.get(line, (*key(i, k), at)), (*key(i, k), at))
    able = [x for x in first if len(x) >= min_edit]
    near = {x for x in able for y in able if x != y and first[y] < first[x] and within_one(x, y)}
    out = []
    for k, (i, t, *_) in enumerate(rows):
        lines = (t or "").split("\n")
        keep = [x for at, x in enumerate(lines) if not x or x not in near and first[x] == (*key(i, k), at)]
        text = t if len(keep) == len(lines) else "\n".join(keep)
        out.append((i, text, len(lines), len(lines) - len(keep)))
    return sorted(out, key=repr)


def test_lines_of_awkward_rows(docs, rows):
    got = line_dedup(docs, n_lines="lines_", n_dropped="dropped_")
    assert got.columns == [*docs.columns, "lines_", "dropped_"]
    assert bag(got, "doc_id", "text", "lines_", "dropped_") == brute_lines(rows)


def test_lines_with_every_kind_of_edit(spark):
    rng = random.Random(8)
    rows, bases = [], [prose(rng, rng.randint(5, 14)) for _ in range(8)] + ["ab" * 15, "aaaaaaaaaaaaaaaaaaaaaaaa", "éü" * 14]
    for k in range(60):
        lines = []
        for _ in range(rng.randint(1, 4)):
            x = rng.choice(bases)
            for _ in range(rng.randint(0, 2)):
                p = rng.randrange(len(x) + 1)
                x = rng.choice([x[:p] + rng.choice("ab é") + x[p:], x[:p] + x[p + 1:], x[:p] + rng.choice("ab é") + x[p + 1:]])
            lines.append(x)
        rows.append((k, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert bag(line_dedup(df), "doc_id", "text", "n_lines", "n_dropped") == brute_lines(rows)


@pytest.mark.parametrize("min_edit", [1, 3, 8])
def test_short_lines(spark, min_edit):
    rng = random.Random(9)
    short = lambda: "".join(rng.choice("ab é") for _ in range(rng.randint(0, 10)))
    rows = [(k, "\n".join(short() for _ in range(rng.randint(0, 6)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert bag(line_dedup(df, min_edit=min_edit), "doc_id", "text", "n_lines", "n_dropped") == brute_lines(rows, min_edit)


def test_lines_of_rows_that_repeat_an_id_or_have_none(spark):
    rows = [(1, "a line\nof two"), (1, "a line\nof two"), (None, "x"), (None, "x"), (None, "y\na line"), (1, "of two\nown")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert bag(line_dedup(df), "doc_id", "text", "n_lines", "n_dropped") == brute_lines(rows)


def test_lines_over_the_length_of_levenshtein(spark, monkeypatch):
    monkeypatch.setattr("brickyard.llm.line_dedup.LONG", 3)
    test_short_lines(spark, 1)


def test_very_long_lines_and_very_many(spark):
    rng = random.Random(10)
    long = prose(rng, 12_000)
    rows = [(1, long), (2, long[:40_000] + "#" + long[40_000:]), (3, long[:9] + long[10:]),
            (4, "\n".join(["}", "", "end"] * 20_000 + ["last"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup(df).collect()}
    assert got == {1: (long, 1, 0), 2: ("", 1, 1), 3: ("", 1, 1), 4: ("\n".join(["}", "", "end", *[""] * 19_999, "last"]), 60_001, 39_998)}


def test_line_dedup_plan_is_native(docs, empty):
    plan = line_dedup(docs.select("doc_id", "text"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert line_dedup(empty.select("doc_id", "text")).count() == 0
