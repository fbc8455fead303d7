"""Frames that the tests of this folder share."""

import random

from pyspark.sql import types as T

#: Names that the operators use inside, as extra columns of the input.
CLASH = ["record", "row", "rows", "key", "h", "n", "id", "class", "bucket", "pos", "score", "kept", "maybe", "ids", "host", "path", "rule", "part", "length", "len", "salt", "_row", "_keep", "_val"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def prose(seed: int, n: int, words: str = "ab cd ef gh ij kl mn op qr st uv wx yz the and of to in") -> str:
    r = random.Random(seed)
    vocabulary = [a + b for a in words.split() for b in words.split()]
    return " ".join(r.choice(vocabulary) for _ in range(n))


def make(spark, rows):
    """A documents frame from (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], SCHEMA)
