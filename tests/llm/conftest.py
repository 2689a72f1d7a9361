import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, kept string, n_words string, component_id string"


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="session")
def mixed():
    """(doc_id, text): unique ids; nulls, blanks, ties, copies, near copies,
    shared passages, repeats inside a text, a long text, odd white space."""
    rng = random.Random(7)
    common = [f"w{i}" for i in range(400)]
    passage, second = words(rng, 60, common), words(rng, 25, common)
    base = words(rng, 120, common).split(" ")
    out = [None, "", "  \t\n", "one", "One", "two words", passage, passage, passage.replace(" ", "\n", 7), passage + "\t"]
    out += [f"{words(rng, rng.randint(0, 40), common)} {passage} {words(rng, 9, common)}" for _ in range(4)]
    out += [f"{second} {words(rng, 5, common)} {second}", f"start {second[3:]}", "of " * 300, "of " * 40, "é à ñ " * 30]
    for i in range(25):  # edited copies at all distances
        copy = list(base)
        for _ in range(i):
            copy[rng.randrange(len(copy))] = rng.choice(common)
        out.append(" ".join(copy))
    out += [words(rng, rng.randint(1, 30), common[:6]) for _ in range(40)]
    out += [words(rng, 30_000, common) + " " + passage, "x" * 5000, "x" * 700]
    ids = list(range(10, 10 + len(out)))
    rng.shuffle(ids)
    return list(zip(ids, out))


@pytest.fixture(scope="session")
def table_of(spark):
    """Rows as documents, with further columns of names that operators use."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", "?", "?", "?") for i, t in rows], SCHEMA).repartition(3)

    return make


EDGE = [(None, "null id " * 30), (None, "null id " * 30), (5, "same row " * 30), (5, "same row " * 30), (5, "other text"),
        (7, "same row " * 30), (None, None), (8, None), (9, "")]
