import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from llm_frames import CLASH, SCHEMA, prose  # noqa: E402


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, equal ids."""
    long = "\n".join(prose(1000 + i, 400) for i in range(100))
    same = prose(7, 80)
    return [(1, same, "en", "s", 3), (1, same, "en", "s", 3), (2, same, "en", None, None), (3, None, "en", "s", None), (4, "", None, "s", 0),
            (5, " \t\n \x0b", "en", "s", 4), (None, prose(8, 60), "en", "s", 1), (None, None, None, None, None), (6, long, "en", "s", len(long)),
            (6, "other text under the same id", None, None, None), (7, "ünï¢ødé Ünï — 漢字 🙂 ​!", "xx", "s", 2), (8, "A", "en", "s", 1),
            (9, "no line break\r\nbut two\r\n\r\n", "en", "s", 1), (10, "x" * 5000, "en", "s", 5000)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, SCHEMA)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
