import collections

import pytest
from pyspark.sql import functions as F

from sparkfolio.sources import ordered
from sparkfolio.sources.sinks import write_split


@pytest.fixture()
def rows(spark):
    """1,000 rows, a third with one key, ties and nulls among them."""
    return spark.range(1_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 != 1, F.col("id") % 11).alias("k"), "id", F.col("id").cast("string").alias("first"))


def test_places_are_those_of_the_order(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    ordered.write_ordered(rows.repartition(5), path, ["k", F.desc("id")], rows_per_file=90)
    got = sorted(ordered.read_ordered(spark, path).collect(), key=lambda r: r["place"])
    want = sorted(rows.collect(), key=lambda r: (r["k"] is not None, r["k"] or 0, -r["id"]))
    assert [r["place"] for r in got] == list(range(1_000))
    assert [(r["k"], r["id"], r["first"]) for r in got] == [tuple(r) for r in want]
    sizes = [r["rows"] for r in ordered.manifest(spark, path).collect()]
    assert max(sizes) <= 90 and sum(sizes) == 1_000


def test_a_range_reads_its_files_alone(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    ordered.write_ordered(rows, path, ["id"], rows_per_file=100)
    for a, z in ((0, 1), (250, 420), (990, 2_000), (1_000, 1_010), (5, 5)):
        part = ordered.read_places(spark, path, a, z)
        assert sorted((r["place"], r["id"]) for r in part.collect()) == [(i, i) for i in range(a, min(z, 1_000))]
    assert len(ordered.read_places(spark, path, 250, 260).inputFiles()) <= 2


def test_ties_and_repeated_rows_have_places_of_their_own(spark, tmp_path):
    path = str(tmp_path / "out")
    ordered.write_ordered(spark.range(500).select(F.lit(1).alias("k"), (F.col("id") % 2).alias("v")), path, ["k"])
    got = ordered.read_ordered(spark, path).collect()
    assert sorted(r["place"] for r in got) == list(range(500)) and collections.Counter(r["v"] for r in got) == {0: 250, 1: 250}


def test_empty_table(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    ordered.write_ordered(rows.limit(0), path, ["k"])
    assert ordered.read_ordered(spark, path).collect() == [] and ordered.read_places(spark, path, 0, 10).collect() == []


def test_a_file_without_a_place_stops_the_job(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    ordered.write_ordered(rows, path, ["id"])
    rows.limit(3).write.mode("append").parquet(path)
    with pytest.raises(Exception, match="not in the manifest"):
        ordered.read_ordered(spark, path).collect()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_split_spreads_a_hot_key(spark, tmp_path, fmt):
    """One key with half of the rows: several files of its own, none above the bound by much."""
    df = spark.range(4_000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 100 != 1, F.concat(F.lit("k"), F.col("id") % 40)).alias("key"),
                                   F.lit("x").alias("kind"), "id").repartition(6)
    path = str(tmp_path / "out")
    write_split(df, path, ["key", "kind"], fmt=fmt, rows_per_file=250)
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    back = reader.format(fmt).load(path)
    cell = lambda r: (r["key"], r["kind"], int(r["id"]))
    assert sorted(map(cell, back.collect()), key=str) == sorted(map(cell, df.collect()), key=str)
    files = back.groupBy("key", F.col("_metadata.file_path").alias("f")).count().collect()
    hot = [r["count"] for r in files if r["key"] == "hot"]
    assert sum(hot) == 2_000 and len(hot) >= 8 and max(r["count"] for r in files) <= 250
    assert collections.Counter(r["key"] for r in files)["k3"] == 1


def test_split_of_nothing_and_clashing_names(spark, tmp_path):
    df = spark.range(10).select("id", F.lit(1).alias("files"), F.lit(2).alias("_files"), F.lit("a").alias("key"))
    for name, some in (("none", df.limit(0)), ("all", df)):
        write_split(some, str(tmp_path / name), ["key"], fmt="parquet", rows_per_file=3)
    got = spark.read.parquet(str(tmp_path / "all"))
    assert sorted(got.columns) == sorted(df.columns) and sorted(r["id"] for r in got.collect()) == list(range(10))
