"""One-hot dictionaries and weights as tables."""

import math

import pytest
from pyspark.sql import functions as F

from sparkfolio.operators import sparse

ROWS = "id int, a string, b string"


def encoded(df, d, **options):
    return {r["id"]: list(r["slots"]) for r in sparse.encode(df, d, "id", **options).collect()}


def test_slots_modes_unknown(spark):
    train = spark.createDataFrame([(1, "x", "q"), (2, "y", "q"), (3, "y", "p"), (4, "x", "p"), (5, None, None)], ROWS)
    d = sparse.fit_dictionary(train, ["a", "b"])
    assert sorted(map(tuple, d.slots.select("feature", "value", "slot").collect())) == [(0, "x", 0), (0, "y", 1), (1, "p", 2), (1, "q", 3)]
    assert {r["feature"]: r["mode"] for r in d.modes.collect()} == {0: "x", 1: "p"}         # ties: the smallest
    new = spark.createDataFrame([(1, "y", "q"), (2, None, "p"), (3, "z", None), (4, "z", "z"), (5, "", "p")], ROWS)
    assert encoded(new, d) == {1: [1, 3], 2: [0, 2], 3: [2], 4: [], 5: [2]}
    assert encoded(new, d, impute=False) == {1: [1, 3], 2: [2], 3: [], 4: [], 5: [2]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], ROWS)
    d = sparse.fit_dictionary(none, ["a", "b"])
    some = spark.createDataFrame([(1, "x", None)], ROWS)
    assert encoded(some, d) == {1: []} and encoded(none, d) == {}
    weights = spark.createDataFrame([], "slot long, weight double")
    assert [tuple(r) for r in sparse.score_by_slot(some, d, weights, "id", 0.0).collect()] == [(1, 0.5, 1)]


def test_score_adds_known_weights(spark):
    train = spark.createDataFrame([(1, "x", "q"), (2, "y", "p")], ROWS)
    d = sparse.fit_dictionary(train, ["a", "b"])
    weights = spark.createDataFrame([(0, 1.5), (2, -0.5), (3, 0.25)], "slot long, weight double")      # slot 1 has none
    new = spark.createDataFrame([(1, "x", "q", 0.5), (2, "y", "p", 0.0), (3, None, "new", -1.0)], ROWS + ", part double")
    got = {r["id"]: (r["probability"], r["label"]) for r in sparse.score_by_slot(new, d, weights, "id", F.col("part")).collect()}
    for i, z in ((1, 0.5 + 1.5 + 0.25), (2, -0.5), (3, -1.0)):
        assert got[i][0] == pytest.approx(1 / (1 + math.exp(-z))) and got[i][1] == (z >= 0)


def test_many_values_and_a_hot_one(spark):
    """100,000 values, one of them in a third of the rows; no value in the plan."""
    n = 150_000
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("a"))
    d = sparse.fit_dictionary(df, ["a"])
    out = sparse.encode(df, d, "id")
    assert "v149999" not in out._jdf.queryExecution().toString()
    r = out.agg(F.count("*").alias("n"), F.countDistinct("slots").alias("k"), F.min(F.size("slots")).alias("low"), F.max(F.size("slots")).alias("high")).first()
    assert tuple(r) == (n, 100_001, 1, 1)
