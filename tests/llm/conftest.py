"""Documents for the operators: a small table with every odd case, and a random one with copies."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, label int"
LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))
ODD = [
    (1, None, "en", None, None, "x", 1),
    (2, "", None, "a", 0, None, None),
    (3, "   \n\t ", "en", "a", 5, "x", 1),
    (4, "...!!! 123", "en", "a", 5, "x", 1),
    (5, "a", "en", "a", 1, "x", 1),
    (6, LONG, "en", "a", len(LONG), "x", 1),
    (7, LONG, "de", "b", len(LONG), "x", 1),
    (7, LONG, "de", "b", len(LONG), "x", 1),
    (8, "naïve café ￼ 日本語   Ünïcode ſK \x00 end", "fr", "b", 10, "x", 1),
    (None, "a row without an id", "en", "c", 3, "x", 1),
    (9, "x" * 50_000, "en", "c", 50_000, "x", 1),
    (10, "1" * 50_000, "en", "c", 50_000, "x", 1),
    (11, "+" + "1 " * 20_000, "en", "c", 50_000, "x", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def invented(seed: int, n: int) -> list[tuple[int, str]]:
    """Invented texts with exact copies, near copies and shared passages."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    say = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    shared = [say(40) for _ in range(5)]
    texts: list[str] = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.35:
            words = rng.choice(texts).split(" ")
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
        elif kind < 0.55:
            texts.append(say(rng.randint(5, 60)) + " " + rng.choice(shared) + " " + say(rng.randint(5, 60)))
        else:
            texts.append(say(rng.randint(1, 200)))
    return list(enumerate(texts))
