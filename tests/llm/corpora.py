"""Small tables for the tests of the training-data operators."""

import random

# Columns named like internal ones, with values that would show.
CLASHING = {name: f"own {name}" for name in ("_id", "_hash", "key", "label", "bucket", "idx", "rank", "words", "n", "list", "rows", "runs", "score")}

PLAIN = [(10**17 + 1, None), (2, ""), (None, "no id, but a text"), (5, "   "), (6, "x" * 5000), (7, "twice"), (7, "twice"), (8, "é \N{WAVING HAND SIGN} \u0301a")]


def documents(spark, rows, clashing=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.char_length("text").cast("long"))
    return df.withColumns({k: F.lit(v) for k, v in CLASHING.items()}) if clashing else df


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["an", "er", "the", "is", "on", "ti", "re", "st", "of", "in"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words))


def exact(value):
    """None for what pandas makes of null."""
    return None if value is None or value != value else value
