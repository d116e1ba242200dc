import random

import pytest

CLASHING = ("id key block rep a b row host n_words kept n_tokens rate slot shard tokens _id _times names seed at mask "
            "found all shift hits content lines label component order").split()


def words(rnd: random.Random, n: int) -> list[str]:
    return ["".join(rnd.choice("abcdeéñ") for _ in range(rnd.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from ``(doc_id, text, source)`` rows."""
    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    rnd = random.Random(5)
    base = words(rnd, 120)
    long = words(rnd, 6000)
    rows = [
        (1, " ".join(base), "s0"), (2, " ".join(base), "s0"), (2, " ".join(base), "s0"),
        (3, " ".join(base[:60] + ["changed"] + base[61:]), None), (4, None, "s1"), (5, "", "s1"), (6, " \n\t ", "s1"),
        (7, "one", "s1"), (8, "one two three", "s1"), (9, "one two three", None), (10, " ".join(long), "s2"),
        (11, " ".join(long[2000:2100]), "s2"), (12, "x " * 5000, "s2"), (13, "y" * 20_000, "s2"), (None, " ".join(base), "s0"),
        (None, None, None), (14, "\n".join(" ".join(base[i : i + 10]) for i in range(0, 120, 10)), "s0"), (15, "a b c d e", "s1"),
        (16, "\x00\x01 \x0b a\x0cb \x1c c", "s1"), (17, "9" * 6_000 + " +" + "1" * 4_000, "s2"),
    ]
    rows += [(100 + i, " ".join(words(rnd, rnd.randint(1, 80)) + base[i : i + 40]), f"s{i % 3}") for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def clashing(spark):
    from pyspark.sql import functions as F

    def add(df):
        return df.withColumns({c: F.lit("extra") for c in CLASHING if c not in df.columns})

    return add
