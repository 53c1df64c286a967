"""Small corpora for the tests."""

import random

SCHEMA = (
    "doc_id bigint, text string, kept int, digest string, place int, row int, bucket string, n int, "
    "_id int, `a.b` int"
)
VOCABULARY = [f"w{i}" for i in range(400)]


def frame(spark, rows):
    """(id, text) rows, with other columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, text, 1, "x", 2, 3, "y", 4, 5, 6) for i, text in rows], SCHEMA)


def prose(seed, n_words, words=VOCABULARY):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n_words))


def odd_rows():
    """Nulls, empty and blank texts, one long text, ties and repeated rows."""
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, prose(4, 120)),
        (5, prose(4, 120)),
        (4, prose(4, 120)),
        (None, prose(4, 120)),
        (None, None),
        (6, "one"),
        (7, "Ünï çödé     text \U0001f600 <|endoftext|>"),
        (8, prose(8, 30_000)),
        (9, "a a a a a a a a\n\n a a a a a a a a \n a a a a a a"),
        (10, "one"),
    ]


def words_of(text, lower=False):
    data = (text or "").encode()
    return [word.decode() for word in (data.lower() if lower else data).split()]
