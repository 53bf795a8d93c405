from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["row", "a", "b", "n", "size", "token", "key", "block", "component", "Step", "part"]


def words(r: random.Random, n: int, stock: int = 400) -> str:
    return " ".join(f"w{r.randrange(stock)}x" for _ in range(n))


def hard_rows(seed: int = 1) -> list[tuple]:
    """Null ids, texts and sources, empty texts, equal rows, near copies, shared passages, one long text."""
    r = random.Random(seed)
    rows = [
        (None, "an orphan of few words here", "en", "s1"),
        (None, None, None, None),
        (1, None, "en", "s1"),
        (2, "", "en", "s0"),
        (3, " \n\t ", "en", "s0"),
        (4, "one two", "en", None),
        (5, "One TWO", "en", "s2"),
        (6, "ça été €uro 😀 " * 60, "fr", "s2"),
        (7, "a" * 450, "en", "s0"),
        (8, words(r, 20_000), "en", "s0"),
    ]
    base, passage = words(r, 120), words(r, 70)
    for i in range(10, 40):
        near = base.split()
        for _ in range(r.choice([0, 1, 2, 4])):
            near[r.randrange(len(near))] = f"edit{i}"
        rows.append((i, " ".join(near), "en", "s0"))
    for i in range(40, 60):
        rows.append((i, f"{words(r, r.randint(5, 90))} {passage} {words(r, r.randint(0, 90))}", "en", r.choice(["s0", "s1"])))
    rows += [(60, "same " + base, "en", "s3")] * 3 + [(61, "same " + base, "en", "s3"), (62, base, "en", "s0"), (62, passage, "en", "s0")]
    return rows


@pytest.fixture(scope="session")
def hard(spark):
    rows = hard_rows()
    df = spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], DOCS)
    for i, name in enumerate(CLASH):
        df = df.selectExpr("*", f"{i} AS `{name}`")
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
