import random

import pytest

SYLLABLES = ["the", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]


def sentence(rng, words):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words)).capitalize() + "."


def prose(seed, words=120):
    rng = random.Random(seed)
    return "\n".join(sentence(rng, rng.randint(5, 15)) for _ in range(max(1, words // 10)))


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents from ``(doc_id, text)`` rows, with columns whose names the operators use inside."""
    def make(rows):
        extra = "body string, digest string, item bigint, root bigint, ids string, label int, score string, word string"
        return spark.createDataFrame([(i, t, *["x", "y", 1, 2, "z", 3, "s", "w"]) for i, t in rows],
                                     f"doc_id bigint, text string, {extra}")
    return make


# Rows that every operator must take: nulls, no words, repeats, ties, a very long text, odd characters.
EDGES = [(1, None), (2, ""), (None, "no id"), (3, " \t\n "), (4, "same text"), (4, "same text"), (5, "same text"),
         (6, "word " * 30_000), (7, "x" * 200_000), (8, "éü中文 \U0001f600    \x00 \x1c tab\tend"),
         (9, "UPPER lower Mixed"), (None, None), (-10, "negative id")]
