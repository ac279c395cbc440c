import random

import pytest

WORDS = "alpha beta gamma delta river stone cloud paper green yellow seven letter window garden simple quiet often under table music".split()


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table from (doc_id, text), with columns whose names operators use themselves."""

    def build(*rows):
        return spark.createDataFrame(
            [(i, t, "en", 7, "kept") for i, t in rows], "doc_id long, text string, lang string, n_words int, score string"
        )

    return build


def prose(seed, words, ends=0.1):
    """Invented sentences, the same for the same seed."""
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) + (". " if rng.random() < ends else "") for _ in range(words))


def edited(text, seed, changes):
    """The text with some words replaced."""
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randint(0, 10**9)}"
    return " ".join(words)


@pytest.fixture(scope="session")
def varied(docs):
    """Nulls, empty and long texts, exact and near copies, ties, repeated rows, equal ids."""
    base = prose(1, 120)
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "one two"), (5, "one two"), (6, "One TWO"), (7, "one  two three"), (None, base), (None, None)]
    rows += [(10 + i, base) for i in range(4)] + [(13, base)]
    rows += [(20 + i, edited(base, i, 2)) for i in range(12)]
    rows += [(40, prose(2, 9000)), (41, edited(prose(2, 9000), 5, 30)), (42, "w " * 5000), (43, "x" * 30000)]
    rows += [(50 + i, prose(50 + i, 30 + i)) for i in range(12)]
    rows += [(70, prose(70, 40)), (70, prose(71, 40)), (71, prose(71, 40))]
    rows += [(80 + i, prose(3, 60) + " " + prose(80 + i, 25)) for i in range(6)]
    return docs(*rows)
