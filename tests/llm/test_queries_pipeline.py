"""Registered queries against their SQL, and the pipeline against brute force stage by stage."""
from __future__ import annotations

import random
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from brickyard.llm import mixing
from brickyard.llm.queries import ORACLES, QUERIES, tokenizer_file
from brickyard.llm.tables import range_bounds, range_of

from .conftest import CLASH, SCHEMA, WORD, awkward, bag, prose
from .test_pack_mix_language import check_packing
from .test_pairs_lines import brute_components, brute_lines

TINY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{TINY}/{table}.parquet')")
    got = QUERIES[name](spark, TINY)
    res = con.execute(ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(got.columns)
    order = sorted(columns)
    want = Counter(tuple(r[columns.index(c)] for c in order) for r in res.fetchall())
    assert Counter(tuple(r[c] for c in order) for r in got.collect()) == want


def test_entry_registers_one_query_per_operator():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())


def test_ranges_cover_and_keep_the_order(spark):
    df = spark.createDataFrame([(i * i % 997,) for i in range(500)] + [(None,)], "k long")
    bounds = range_bounds(df, "k", 90)
    rows = sorted((r["k"] if r["k"] is not None else 10**9, r["p"]) for r in df.select("k", range_of(df["k"], bounds).alias("p")).collect())
    assert rows[0][1] == 0 and [p for _, p in rows] == sorted(p for _, p in rows) and rows[-1][1] == len(bounds) - 1 > 60


def fixture_rows():
    rng = random.Random(21)
    out = [(i, t, la, s) for i, t, la, s in awkward() if i is not None]
    for i in range(200, 240):
        words = prose(rng, 80).split()
        out.append((i, " ".join(words), rng.choice(["en", "fr"]), rng.choice(["a", "b", None])))
        if i % 5 == 0:                           # a near copy on other lines, so that only the join finds it
            at = rng.randrange(70)
            out.append((i + 100, "\n".join([" ".join([*words[:at], "new"]), " ".join(words[at + 1:])]), "en", "c"))
    return out


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    rows = fixture_rows()
    data = [(i, t, la, s, None if t is None else len(t), *["1"] * len(CLASH)) for i, t, la, s in rows]
    docs = spark.createDataFrame(data, SCHEMA)
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{k}")
        seen[name] = (docs, out := spark.read.parquet(f"{tmp_path}/{k}"))
        docs = out

    def pairs(df):
        return [(r["doc_id"], r["text"]) for r in df.collect()]

    before, after = (pairs(x) for x in seen["language_id"])
    assert Counter(after) <= Counter(before)
    assert all(not any(c.isalpha() for c in t or "") for i, t in (Counter(before) - Counter(after)))
    before, after = (pairs(x) for x in seen["line_dedup"])
    assert Counter(after) == Counter((i, t) for i, t, _, dropped in brute_lines(before) if not dropped or (t or "").strip(" \n"))
    before, after = (pairs(x) for x in seen["jaccard_join"])
    groups = defaultdict(list)
    numbered = [(k, t) for k, (_, t) in enumerate(before)]
    for k, _, component in brute_components(numbered):
        groups[component].append(before[k])
    assert len(after) == len(groups) and Counter(after) <= Counter(before)
    kept = Counter(after)
    assert all(any(kept[x] for x in own) for own in groups.values()) and any(len(own) > 1 for own in groups.values())
    before, after = seen["mix_sources"]
    words = Counter()
    for i, t in pairs(after):
        words[i] += len(WORD.findall(t))
    taken = Counter()
    for r in mixing.mix_query(before).collect():
        taken[r["doc_id"]] += r["taken"]
    assert words == +taken
    before, after = seen["packing"]
    texts = defaultdict(list)
    for i, t in pairs(before):
        texts[i].append(t)
    from tokenizers import Tokenizer

    check_packing(after.collect(), texts, Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json")))


def test_pipeline_of_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/e{k}")
        docs = spark.read.parquet(f"{tmp_path}/e{k}")
    assert docs.count() == 0 and bag(docs, "doc_id") == []
