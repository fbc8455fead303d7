import collections

import pytest
from pyspark.sql import functions as F

from sparkfolio.llm import sharding as S


def check(placed, n, shards):
    rows = placed.collect()
    assert len(rows) == n
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return rows


@pytest.mark.parametrize("n,shards,bucket", [(1000, 8, 400), (1000, 7, 10 ** 9), (3, 8, 10), (1, 1, 10), (17, 5, 1)])
def test_rows_law(spark, n, shards, bucket):
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 9).cast("int")).alias("text"))
    rows = check(S.external_shuffle(df, shards, bucket_bytes=bucket), n, shards)
    assert sorted(r["record"]["doc_id"] for r in rows) == list(range(n))


def test_seeded_and_shuffled(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    order = lambda seed: [r["record"]["doc_id"] for r in S.external_shuffle(df, 1, seed, bucket_bytes=2000).orderBy("slot").collect()]
    a, b, c = order(1), order(1), order(2)
    assert a == b != c and sorted(a) == list(range(2000))
    neighbours = sum(abs(x - y) == 1 for x, y in zip(a, a[1:]))
    assert neighbours < 20 and 850 < sum(a[:1000]) / 1000 < 1150


def test_odd_and_repeated_rows(odd, odd_rows, nothing, spark):
    rows = check(S.external_shuffle(odd, 4, bucket_bytes=1000), len(odd_rows), 4)
    assert collections.Counter((r["record"]["doc_id"], r["record"]["text"]) for r in rows) == collections.Counter(r[:2] for r in odd_rows)
    assert S.external_shuffle(nothing, 4).collect() == []
    alike = spark.range(5000).select(F.lit(1).alias("doc_id"), F.lit("same").alias("text"))
    check(S.external_shuffle(alike, 8, bucket_bytes=2000), 5000, 8)


def test_written_shards(documents, tmp_path, spark):
    S.write_shards(S.external_shuffle(documents, 3), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == documents.count() and {r["_shard"] for r in back.select("_shard").distinct().collect()} == {0, 1, 2}


def test_native_plan(documents):
    plan = S.external_shuffle(documents, 8)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
