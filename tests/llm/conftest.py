"""A small corpus with the cases that every operator defines: nulls, empty and long texts, copies, repeated rows, clashing columns."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k string, h long, n int, fp long, score double, id string, rid long, size long"


def corpus() -> list[tuple]:
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]

    def text(n: int) -> str:
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = text(60)
    base = text(120)
    rows = [(i, text(rng.randint(1, 90)), rng.choice(["en", "de"]), rng.choice(["a", "b", "c"])) for i in range(60)]
    rows += [(100 + i, base if i % 3 else base.replace(" ", "\n", i + 1), "en", "a") for i in range(12)]  # copies but for white space
    for i in range(12):  # near copies
        w = base.split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((200 + i, " ".join(w), "en", "b"))
    rows += [(300 + i, f"{text(20)} {passage.upper() if i % 2 else passage} {text(20)}", "fr", "c") for i in range(8)]
    rows += [(400, text(30_000), "en", "a"), (401, "", "en", "a"), (402, None, None, None), (403, "   \t\n", "en", None), (404, "ÉtÉ 漢字 x", "fr", "b")]
    rows += [(405, "a" * 3000, "en", "a"), (406, "ab " * 700, "en", "a"), (407, "one", "en", "d"), (None, text(40), "en", "a"), (None, base, "en", "a")]
    rows += [rows[3], rows[3], rows[70], (5, rows[5][1], "en", "a")]  # rows repeated whole, or but for a column
    return [(*r, len(r[1]) if r[1] else None, "x", 1, 2, 3, 0.5, "y", 7, 9) for r in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def items(spark, rows):
    passage = rows[85][1].split()
    data = [(1, " ".join(passage[25:70])), (2, " ".join(rows[7][1].split()[:4])), (3, None), (4, ""), (None, " ".join(passage[30:50])), (1, "one"), (10, "one"), (2, "not in there at all")]
    return spark.createDataFrame(data, "item_id long, text string")
