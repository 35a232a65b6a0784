import random

import pytest

from plantlake.llm.common import ship


@pytest.fixture(scope="session")
def llm(spark):
    return ship(spark)


@pytest.fixture
def texts(llm):
    """A table of documents with two extra columns whose names clash with names inside the operators."""

    def make(rows):
        schema = "doc_id bigint, text string, source string, cls string, key int"
        return llm.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], schema)

    return make


def prose(rng: random.Random, n: int, alphabet: str = "abcdefghijklmnop") -> str:
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(n))


#: Texts that every operator must bear: NULL, empty, white space, one word, repeats, a very long one, wide characters.
def awkward(rng: random.Random) -> list:
    long = prose(rng, 30_000)
    return [
        (None, "no id at all", "s1"),
        (None, None, None),
        (1, None, "s1"),
        (2, "", "s1"),
        (3, " \n\t ", None),
        (4, "word", "s2"),
        (5, "word", "s2"),
        (5, "word", "s2"),
        (6, long, "s2"),
        (7, "é😀 漢字 ▁   x" * 20, "s3"),
        (8, "a" * 5000, "s3"),
    ]
