"""Row positions on a whole table: no row may be lost or placed twice."""

import pytest
from pyspark.sql import functions as F

from sparkfolio.operators.frame import Frame
from sparkfolio.operators.rows import keep_first, slice_rows, zip_rows, with_group_rank, with_row_index, with_running_sum

LINES = "/root/testdata/sf0.1/lineitem.parquet"


@pytest.fixture(params=["true", "false"])
def reuse(spark, request):
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield
    spark.conf.unset("spark.sql.exchange.reuse")


def dense(df, tmp_path, spark, n):
    """Written and read back: every position 0..n-1 once."""
    df.write.parquet(str(tmp_path / "t"))
    r = spark.read.parquet(str(tmp_path / "t")).agg(F.count("*"), F.countDistinct("row_idx"), F.min("row_idx"), F.max("row_idx")).first()
    assert tuple(r) == (n, n, 0, n - 1)


def test_keyless_index(spark, reuse, tmp_path):
    li = spark.read.parquet(LINES)
    n = li.count()
    dense(with_row_index(li.select("l_orderkey", "l_comment" if "l_comment" in li.columns else "l_quantity")), tmp_path, spark, n)


def test_keyed_index_and_group_rank(spark, reuse, tmp_path):
    li = spark.read.parquet(LINES).select("l_orderkey", "l_linenumber", "l_returnflag")
    n = li.count()
    dense(with_row_index(li, ["l_returnflag"]), tmp_path, spark, n)
    ranked = with_group_rank(li, ["l_returnflag"], ["l_orderkey", "l_linenumber"], "rk", "size")
    for r in ranked.groupBy("l_returnflag", "size").agg(F.count("*").alias("c"), F.countDistinct("rk").alias("d"), F.max("rk").alias("m")).collect():
        assert r["c"] == r["d"] == r["size"] == r["m"] + 1


def test_under_a_union(spark, reuse, tmp_path):
    li = spark.read.parquet(LINES).select("l_orderkey").limit(50_000)
    both = with_row_index(li).unionByName(with_row_index(li))
    r = both.agg(F.count("*"), F.countDistinct("row_idx"), F.max("row_idx")).first()
    assert tuple(r) == (100_000, 50_000, 49_999)
    dense(with_row_index(li.unionByName(li)), tmp_path, spark, 100_000)


def test_slices_and_lists_keep_every_row(spark):
    li = spark.read.parquet(LINES).select("l_orderkey", "l_linenumber")
    n = li.count()
    assert slice_rows(li, 0, None).count() == n and slice_rows(li, 5, -5, ordered=False).count() == n - 10
    f = Frame(li)
    assert len(f[[True] * n]) == n
    f["i"] = list(range(n))
    assert f.df.agg(F.countDistinct("i")).first()[0] == n
    with pytest.raises(ValueError):
        f[[True] * (n - 1)]


def test_order_of_files(spark, tmp_path):
    for k, name in enumerate("bca"):
        spark.range(1000 * k, 1000 * k + 700, 1, 1).write.parquet(str(tmp_path / f"in/part={name}"))
    df = spark.read.parquet(str(tmp_path / "in"))
    got = [r["id"] for r in with_row_index(df).orderBy("row_idx").select("id").collect()]
    assert got == [*range(2000, 2700), *range(0, 700), *range(1000, 1700)]


def test_running_sum(spark, reuse):
    df = spark.range(200_000).select("id", F.when(F.col("id") % 5 != 0, F.col("id") % 97 + 2 ** 45).alias("v"))
    run = with_running_sum(df, ["id"], "v", "s", inclusive=True)
    top = run.orderBy(F.col("id").desc()).first()["s"]
    assert run.count() == 200_000 and top == df.agg(F.sum("v")).first()[0]


def test_keep_first_missing_order(spark):
    rows = [(1, None, "a"), (1, None, "b"), (2, None, "c"), (2, 5, "d"), (2, 5, "e"), (2, 7, "f"), (None, 1, "g"), (None, 0, "h")]
    got = {r["k"]: (r["o"], r["x"]) for r in keep_first(spark.createDataFrame(rows, "k int, o int, x string"), ["k"], "o").collect()}
    assert got[1][0] is None and got[1][1] in "ab" and got[2][0] == 5 and got[2][1] in "de" and got[None] == (0, "h")
    again = {r["k"]: r["x"] for r in keep_first(spark.createDataFrame(rows[::-1], "k int, o int, x string"), ["k"], "o").collect()}
    assert again == {k: x for k, (_, x) in got.items()}


def test_zip_of_two_tables_with_different_splits(spark, tmp_path):
    """Rows meet by position whatever the files are; names that the operator uses inside do not clash."""
    n = 5_000
    spark.range(n).select("id", F.col("id").alias("i"), F.lit("x").alias("left"), F.lit(1).alias("value")).repartitionByRange(7, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "a"))
    spark.range(n).select((F.col("id") * 3).alias("v"), (F.col("id") % 4 == 0).alias("flag"), F.lit(2).alias("_row")).repartitionByRange(3, "v").sortWithinPartitions("v").write.parquet(str(tmp_path / "b"))
    a, b = spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "b"))
    both = zip_rows(a, b)
    assert both.columns == ["left", "right", "i"] and both.where("right.v <> 3 * left.id or i <> left.id").count() == 0 and both.count() == n
    f, g = Frame(a), Frame(b)
    kept = f[g.rows("flag")]
    assert kept.columns == a.columns and [r["id"] for r in kept.df.collect()] == list(range(0, n, 4))
    f["v"] = g.rows("v")
    f["again"] = f.rows("id")           # the order is still that of the files
    assert f.df.where("v <> 3 * id or again <> id").count() == 0 and f.columns == ["id", "i", "left", "value", "v", "again"]
    with pytest.raises(ValueError):
        zip_rows(a, b.limit(10))
    assert zip_rows(a.limit(0), b.limit(0)).count() == 0


def test_null_flags_select_nothing(spark, tmp_path):
    spark.createDataFrame([(True,), (None,), (False,)], "flag boolean").coalesce(1).write.parquet(str(tmp_path / "f"))
    f = Frame.from_columns(spark, ["a"], {"a": ["1", "2", "3"]})
    assert [r.a for r in f[Frame(spark.read.parquet(str(tmp_path / "f"))).rows("flag")].df.collect()] == ["1"]
