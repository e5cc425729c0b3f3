from __future__ import annotations

import random

import pytest

from renewlens.llm.queries import workers_import

SCHEMA = "doc_id long, text string, lang string, node string, keys int"


@pytest.fixture(autouse=True)
def _importable(spark):
    workers_import(spark)


def prose(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(("ta", "ri", "on", "the", "ing", "mo", "su", "el")) for _ in range(rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): plain, copied, near-copied, null, empty, blank, very
    long, repetitive and tiny texts; one row comes twice."""
    rows = [(i, " ".join(prose(i, 120)) + ".\n" + " ".join(prose(1000 + i, 60))) for i in range(30)]
    words = rows[3][1].split(" ")
    for j in range(6):  # a family of near copies
        w = list(words)
        w[20 + 11 * j] = f"edit{j}"
        rows.append((100 + j, " ".join(w)))
    rows += [(200, rows[5][1]), (201, rows[5][1]), (300, None), (301, None), (302, ""), (303, ""), (304, " \t\n "), (305, "one two"),
             (306, "one two"), (307, " ".join(prose(77, 9000))), (308, "same line again here\n" * 40), (309, "漢字の文章です。" * 30), (30, "dup row " + rows[7][1])]
    rows.append(rows[-1])
    return rows


@pytest.fixture()
def docs(spark, corpus):
    """The corpus with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "xx" if i % 2 else None, "n", 7) for i, t in corpus], SCHEMA).repartition(3)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
