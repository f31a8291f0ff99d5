import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"

#: What every operator must take: nulls, nothing, blanks, one long text, ties and repeated rows.
EDGES = [
    (None, "A row without an id.", "en", None, None),
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, " \n\t \n", "en", "s", 5),
    (4, "12 34 !! ??", None, "s", 11),
    (5, "the same row", "en", "s", 12),
    (5, "the same row", "en", "s", 12),
    (6, "word " * 20_000, "en", "s", 100_000),
    (7, "Ünïcödé — ça va? 日本語 \U0001f600 <|endoftext|> <|startoftext|>x", "fr", "s", 30),
]


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of documents, with columns whose names operators might use themselves."""

    def make(rows):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], COLUMNS)
        return df.withColumns({c: F.lit(-1) for c in ("score", "fp", "root", "cell", "lang_pred", "held_out", "h", "key", "n", "word", "row", "_id", "_bad", "_gone", "n_dropped", "kept")})

    return make


@pytest.fixture(scope="session")
def edges(frame):
    return frame(EDGES)


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])


@pytest.fixture(scope="session")
def prose():
    """prose(n, seed): n words that no other seed gives in this order."""

    def make(n, seed):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefghijklmnoprstuvwy") for _ in range(rng.randint(2, 9))) for _ in range(n))

    return make
