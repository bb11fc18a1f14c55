"""Small documents with every odd case, and the given tables."""

from __future__ import annotations

import random

import pytest

LINE = "This passage stands in many documents and is long enough."
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, kept string, shard int, numbers string, length int, print int"


def _texts() -> list[str | None]:
    rng = random.Random(5)
    words = [a + b for a in "ka lo mi né ru st ve xi".split() for b in "bar dil fon gus hem".split()]

    def prose(n: int) -> str:
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", ", ", ". ", "\n"]) for _ in range(n))

    base = prose(120)
    near = base.split(" ")
    near[40] = "other"
    texts: list[str | None] = [None, "", "   ", "\n\n", "word", base, base, base, " ".join(near), base.upper()]
    texts += [f"{prose(60)}\n  {LINE.upper() if i % 2 else LINE}\t\n{prose(30)}" for i in range(5)]
    texts += [prose(3) + base[100:420] + prose(80) for _ in range(4)]
    long = prose(9000)
    parts = long.split(" ")
    texts += [" ".join("other" if i % 97 == 5 and i < 97 * n else part for i, part in enumerate(parts)) for n in (4, 8, 12)]
    texts += [long, "a" * 3000, "ab " * 700, "1 2 3 " * 60, "THE!! END!! " * 40, "x | y $$$ %%% " * 40]
    texts += [f"Licensed under the Apache License, Version 2.{i}. {prose(50)} GNU Genral Public License" for i in range(2)]
    texts += ["mail me: a.b+c@mail.example.org, x@y.z_d@e.f or +1 (555) 010-9999 at 10.0.0.255 or 10.0.0.256, card 4111 1111 1111 1111",
              "Account DE89370400440532013000 and GB82 WEST 1234 5698 7654 32, not XDE89370400440532013000. 4111-1111-1111-1112 001.2.3.4.5",
              "Social security 123-45-6789; order 123-45-6789 é 1+1 +12345678 9é"]
    return texts


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    """Rows of `documents` with more columns; an id that is null, an id that repeats with equal and with another text."""
    found = [(i, t, "en", "s", len(t or ""), "k", 1, "n", 2, 3) for i, t in enumerate(_texts())]
    found += [(None, found[5][1], None, None, None, None, None, None, None, None), found[7], (7, "another text with the same id " * 20, "en", "s", 1, "k", 1, "n", 2, 3)]
    return found


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SHAPE).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="session")
def items(spark):
    text = "Alpha beta gamma delta, epsilon zeta eta theta iota kappa lambda mu."
    return spark.createDataFrame([(1, text), (1, text), (2, "short one"), (3, None), (None, "null id"), (4, " .,;"), (10, "né ka")], "item_id long, text string")


@pytest.fixture
def ordered():
    """Rows of a result as sorted tuples."""

    def of(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)

    return of
