import random

import pytest

from fleetlens.llm.queries import prepare

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    prepare(spark)
    return spark


def some_words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(2, 7))) if rng.random() < 0.1 else f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def odd_rows() -> list[tuple]:
    """Nulls in each column, empty and blank texts, repeated rows and ids, a
    very long text, one-word texts."""
    rng = random.Random(5)
    long = " ".join(some_words(rng, 120_000, 20_000))
    same = " ".join(some_words(rng, 80))
    return [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b\x0c\r ", "en", "a", 7),
        (4, "one", "en", "a", 3),
        (5, "one", "en", "a", 3),
        (6, same, None, None, len(same)),
        (6, same, None, None, len(same)),
        (6, "another text of the same id", "en", None, 27),
        (7, same, None, "b", len(same)),
        (None, same, "en", "b", len(same)),
        (None, None, None, None, None),
        (8, long, "en", "a", len(long)),
        (9, long + " end", "en", "a", len(long) + 4),
        (10, "# ### </turn> \\ <|endoftext|> it's 　 x y", "en", "a", 1),
    ]


@pytest.fixture(scope="session")
def odd_docs(llm):
    return llm.createDataFrame(odd_rows(), DOC_SCHEMA)


@pytest.fixture(scope="session")
def clash(llm, odd_docs):
    """The same rows with columns that have the operators' own names."""
    from pyspark.sql import functions as F

    names = "n n_words same row token doc node component component_id kept found start source_doc anchors x0 own wide key rate copies task at ids length vslot size shard bits tokens n_removed __kept rest c0 c1 bitmap lo windows factors"
    odd = ["page url", "a.b", 'quoted "`name']
    # By place, so that names with dots and quotes can be given.
    return odd_docs.select("*", *(F.lit("clash") for _ in [*names.split(), *odd])).toDF(*odd_docs.columns, *names.split(), *odd)


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], DOC_SCHEMA)
