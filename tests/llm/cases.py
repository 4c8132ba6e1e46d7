"""Documents with awkward rows, and random ones with copies, for all operators."""

import random

from pyspark.sql import functions as F

KINDS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and river stone Apple bright mountain über café 東京 x1 don't 3.14 license free".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ",", "\n"]) + str(rng.randrange(40)) for _ in range(n))


def awkward():
    rng = random.Random(5)
    long_text = prose(rng, 4000)
    some = prose(rng, 60)
    return [
        (1, some, "en", "a", 1),
        (1, some, "en", "a", 1),  # a repeated row
        (2, some, None, None, None),
        (3, None, "en", "a", 0),
        (4, "", "en", "a", 0),
        (5, " \t\n ", "de", "a", 4),
        (6, "one", "en", "b", 3),
        (7, "one", "en", "b", 3),
        (None, some, "en", "a", 1),
        (None, None, None, None, None),
        (8, long_text, "en", "a", 1),
        (9, long_text + " more", "en", "a", 1),
        (10, "w" * 50_000, "en", "a", 1),
        (10, prose(rng, 30), "en", "a", 1),  # an id with two texts
        (11, "same words " * 400, "fr", "a", 1),
        (12, "\x00\x1c　 odd spaces <|endoftext|> \U0001f600", "xx", "a", 1),
    ]


def random_documents(n=150, seed=3):
    rng = random.Random(seed)
    rows, passage = [], prose(rng, 25)
    for i in range(n):
        text = prose(rng, rng.randrange(1, 120))
        if rows and rng.random() < 0.3:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        if rng.random() < 0.3:
            text += " " + passage
        rows.append((i * 3 % 451, text, rng.choice(["en", "de"]), "s", len(text)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, KINDS).repartition(3)


def clashing(documents):
    """Columns named like what operators add."""
    names = ["n_words", "kept", "tag", "key", "at", "language", "ids", "n_removed", "contaminated", "bench_key", "part"]
    return documents.withColumns({n: F.lit("mine") for n in names})


def empty(spark):
    return spark.createDataFrame([], KINDS)
