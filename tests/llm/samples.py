"""Tables the tests of the pipeline operators share."""

import random

# Columns that clash with names the operators use inside.
EXTRA = ["score", "root", "node", "key", "w0", "mark", "range", "row", "term", "bucket", "part", "g", "ctx",
         "unit", "size", "data", "kept", "label", "stats", "events", "ids", "n", "start", "spans", "held_out"]


def documents(spark, rows):
    """A table of documents from (doc_id, text) pairs, with clashing columns."""
    extra = ", ".join(f"{c} string" for c in EXTRA)
    full = [(i, t, None, "s", None, *["x"] * len(EXTRA)) for i, t in rows]
    return spark.createDataFrame(
        full, f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    )


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# Nulls, empty and white texts, repeated rows and ids, characters of several bytes, a very long text.
EDGE = [
    (None, None), (None, "a b c d"), (1, None), (1, ""), (2, " \n\t "), (3, words(1, 30_000)), (4, "A b c"),
    (4, "A b c"), (5, "ünï 😀 日本 <|endoftext|>  x"), (6, "a\u0000b\\c"), (7, words(2, 50)), (8, words(2, 50)),
]
