"""Documents with every awkward case, and brute-force forms of what operators compute."""
from __future__ import annotations

import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Extra columns whose names clash with the operators' own working columns.
CLASH = ["id", "row", "size", "sig", "kind", "key", "part", "label", "n", "line", "evidence", "host",
         "spans", "accepted", "confidence", "lang_id", "ids", "starts", "decoded", "phrase", "score", "rank", "place", "term", "item"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def prose(rng: random.Random, words: int, stems=("ther", "and", "ing", "of", "hand", "stone", "er", "re", "lake", "tion")) -> str:
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(words))


def awkward() -> list[tuple]:
    """(doc_id, text, lang, source): NULLs, empty and very long texts, copies, near
    copies, repeated lines and passages, a repeated row, a repeated id, a NULL id."""
    rng = random.Random(5)
    base = prose(rng, 120)
    words = base.split()
    near = " ".join([*words[:60], "CHANGED", *words[61:]])
    passage = prose(rng, 45)
    lines = [prose(rng, 12) for _ in range(6)]
    edited = lines[2][:9] + "#" + lines[2][10:]
    longer = lines[3][:5] + "x" + lines[3][5:]
    long = " ".join(prose(rng, 30) for _ in range(200))
    texts = [
        (7, base, "en", "a"), (3, base, "en", "b"), (12, base.upper(), "en", "a"), (5, near, "en", None),
        (20, None, None, None), (21, "", "de", "b"), (22, " \t\n ", None, "b"), (23, None, "en", "a"),
        (30, long, "en", "a"), (31, prose(rng, 30) + " " + passage + " " + prose(rng, 12), "fr", "c"),
        (32, passage + " " + prose(rng, 25), "en", "c"), (33, prose(rng, 9) + "\n" + passage + "  " + passage, "es", "a"),
        (40, "\n".join(lines), "en", "a"), (41, "\n".join([lines[1], edited, prose(rng, 11)]), "en", "a"),
        (42, "\n".join([longer, "short", "short"]), "en", "b"), (42, "another text under an id that is taken", "en", "b"),
        (43, "one", "en", "z"), (44, "one", "en", "z"), (45, "é ü ñ 漢字 \U0001F600 tab\tend ", "fr", "z"),
        (46, "!!! $$$ 123", "en", "z"), (47, "x" * 3000, "en", "Z"), (None, "a row without an id, but with words", "en", "a"),
        (50, "ab cd", "en", "a"), (50, "ab cd", "en", "a"), (60, "\n".join(["same line that comes again"] * 4), "en", "b"),
    ]
    rng.shuffle(texts)
    return texts


@pytest.fixture(scope="session")
def rows():
    return awkward()


@pytest.fixture(scope="session")
def docs(spark, rows):
    data = [(i, t, la, s, None if t is None else len(t), *["1"] * len(CLASH)) for i, t, la, s in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
