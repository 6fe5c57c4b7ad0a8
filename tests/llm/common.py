"""Rows of awkward cases, and plain versions to hold the operators against."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, at string, digest string, fp string"


def table(spark, rows):
    """Documents from (doc_id, text, source) with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, 0, "x", "y", "z", "w") for i, t, s in rows], SCHEMA)


def prose(seed, words, vocabulary=400):
    pick = random.Random(seed)
    stems = ["".join(random.Random(k).choices("abcdefghilmnoprstu", k=3 + k % 6)) for k in range(vocabulary)]
    return " ".join(pick.choice(stems) for _ in range(words))


def awkward():
    long = prose(1, 60_000)
    return [
        (1, "one two three four", "a"), (2, "one  two\nthree four ", "a"), (3, None, "a"), (4, "", None), (5, " \t\n", "b"),
        (6, long, "b"), (7, long, None), (8, prose(2, 300), "c"), (8, prose(2, 300), "c"), (9, prose(2, 300) + " more", "c"),
        (None, "one two three four", "c"), (None, None, None), (10, "É" * 50 + " <|endoftext|> ünï 日本", "a"),
        (11, "A" * 1000, "d"), (12, "ab" * 700, "d"), (13, prose(3, 80), "d"), (14, prose(4, 40) + prose(3, 80) + prose(5, 40), "d"),
    ]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
