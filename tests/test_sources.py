"""Readers and sinks."""

import json
import os
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.sources import readers as R
from sparkfolio.sources import sinks


def _w(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_glob_union_by_name_and_fallback(spark, tmp_path):
    _w(tmp_path / "dailyActivity_a.csv", "Id,Activity Date,Total Steps\n1,4/12/2016,100\n")
    _w(tmp_path / "dailyActivity_b.csv", "Total Steps,Id\n7,2\n")
    df = R.read_csv_glob(spark, [str(tmp_path / "dailyActivity*merged*.csv"),
                                 str(tmp_path / "dailyActivity_*.csv")], all_string=True)
    df = R.normalise_headers(df, {"ActivityDate": "Date"})
    rows = sorted((r.Id, r.Date, r.TotalSteps) for r in df.collect())
    assert rows == [("1", "4/12/2016", "100"), ("2", None, "7")]
    try:
        R.read_csv_glob(spark, [str(tmp_path / "none*.csv")])
        raise AssertionError("expected FileNotFoundError")
    except FileNotFoundError:
        pass


def test_optional_source(spark, tmp_path):
    schema = T.StructType([T.StructField("Id", T.LongType()), T.StructField("SleepDay", T.StringType())])
    empty = R.read_optional_csv(spark, [str(tmp_path / "sleepDay_merged.csv")], schema)
    assert empty.count() == 0 and empty.columns == ["Id", "SleepDay"]
    _w(tmp_path / "sleepDay.csv", "Id,SleepDay\n5,4/12/2016\n")
    got = R.read_optional_csv(spark, [str(tmp_path / "sleepDay_merged.csv"), str(tmp_path / "sleepDay.csv")], schema)
    assert got.first().Id == 5


def test_statement_globs(spark, tmp_path):
    assert R.read_statement_globs(spark, [str(tmp_path)]) is None
    _w(tmp_path / "001_IS_raw.csv", "account_nm,thstrm_amount\n매출액,\"1,000\"\n")
    _w(tmp_path / "001_BS_raw.csv", "thstrm_amount,account_nm,extra\n5,유동자산,x\n")
    df = R.read_statement_globs(spark, [str(tmp_path / "missing"), str(tmp_path)])
    assert sorted((r.account_nm, r.thstrm_amount) for r in df.collect()) == [("매출액", "1,000"), ("유동자산", "5")]


def test_status_payload(spark, tmp_path):
    _w(tmp_path / "ok.json", json.dumps({"status": "000", "list": [{"account_nm": "a", "thstrm_amount": "1"},
                                                                   {"account_nm": "b", "thstrm_amount": "2"}]}))
    _w(tmp_path / "bad.json", json.dumps({"status": "013", "list": [{"account_nm": "z"}]}))
    row = T.StructType([T.StructField("account_nm", T.StringType()), T.StructField("thstrm_amount", T.StringType())])
    df = R.read_status_payload(spark, str(tmp_path), row)
    assert sorted(r.account_nm for r in df.collect()) == ["a", "b"]


def test_xml_rows(spark, tmp_path):
    _w(tmp_path / "corp.xml", "<result><list><corp_code>001</corp_code><corp_name>A</corp_name>"
       "<stock_code>51900</stock_code></list><list><corp_code>002</corp_code><corp_name>B</corp_name>"
       "<stock_code> </stock_code></list></result>")
    df = R.read_xml_rows(spark, str(tmp_path / "corp.xml"))
    from sparkfolio.functions.coerce import zero_pad
    got = sorted((r.corp_code, r.code) for r in df.select("corp_code", zero_pad("stock_code").alias("code")).collect())
    assert got == [("001", "051900"), ("002", None)]


def test_price_history_range(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2019, 1, 1), 1.0), (dt.date(2019, 1, 2), 2.0), (dt.date(2018, 12, 31), 0.5)],
                               "date date, High double")
    got = R.price_history(df, "2019-01-01", "2019-01-02", value_col="High").collect()
    assert [(r.date.day, r.high) for r in got] == [(1, 1.0)]


def test_sinks_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("A", "IS", 1), ("A", "BS", 2), ("B", "IS", 3)], "t string, sj string, v int")
    sinks.write_csv(df, str(tmp_path / "all"))
    assert spark.read.option("header", True).csv(str(tmp_path / "all")).count() == 3
    sinks.write_split(df, str(tmp_path / "split"), ["t", "sj"])
    assert sorted(os.listdir(tmp_path / "split" / "t=A")) == ["sj=BS", "sj=IS"]
    pruned = spark.read.option("header", True).csv(str(tmp_path / "split")).where("t = 'B'")
    assert pruned.count() == 1
    sinks.write_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 3
    sinks.create_table_as(df.where(F.col("v") > 1), "ctas_probe", path=str(tmp_path / "ctas"))
    assert spark.table("ctas_probe").count() == 2
    spark.sql("DROP TABLE ctas_probe")


def test_glob_keep_first_follows_file_order(spark, tmp_path):
    from sparkfolio.operators.rows import keep_first
    _w(tmp_path / "dailyActivity_1.csv", "Id,Date,Steps\n1,d1,10\n1,d1,11\n2,d1,5\n")
    _w(tmp_path / "dailyActivity_2.csv", "Id,Date,Steps\n1,d1,99\n3,d2,7\n")
    df = R.read_csv_glob(spark, [str(tmp_path / "dailyActivity_*.csv")], all_string=True,
                         position_col="_pos")
    got = sorted((r.Id, r.Date, r.Steps) for r in keep_first(df, ["Id", "Date"], "_pos").collect())
    assert got == [("1", "d1", "10"), ("2", "d1", "5"), ("3", "d2", "7")]


def test_price_history_requires_rows(spark):
    import datetime as dt
    import pytest
    df = spark.createDataFrame([(dt.date(2019, 1, 1), 1.0)], "date date, High double")
    with pytest.raises(ValueError):
        R.price_history(df, "2020-01-01", "2020-02-01", value_col="High", require_rows=True)


def test_frame_drop_ignore(spark):
    from sparkfolio.operators.frame import Frame
    f = Frame.from_columns(spark, ["a", "b"], {"a": [1], "b": [2]})
    assert f.drop(columns=["zz", "a"], errors="ignore").columns == ["b"]


def test_bucketed_join_has_no_shuffle(spark, tmp_path):
    import io
    import contextlib
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_quantity")
    od = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderstatus")
    sinks.write_bucketed(li, "b_lineitem", ["l_orderkey"], 8, str(tmp_path / "bl"))
    sinks.write_bucketed(od, "b_orders", ["o_orderkey"], 8, str(tmp_path / "bo"))
    j = spark.table("b_lineitem").join(spark.table("b_orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        j.explain()
    plan = buf.getvalue()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert j.count() == li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).count()
    spark.sql("DROP TABLE b_lineitem")
    spark.sql("DROP TABLE b_orders")


def test_head_follows_file_order(spark, tmp_path):
    from sparkfolio.operators.frame import Frame
    _w(tmp_path / "a.csv", "k,v\n" + "".join(f"a{i},{i}\n" for i in range(3)))
    _w(tmp_path / "b.csv", "k,v\n" + "".join(f"b{i},{i}\n" for i in range(50)))
    df = spark.read.option("header", True).csv(str(tmp_path))
    got = [r.k for r in Frame(df).head(4).df.collect()]
    assert got == ["a0", "a1", "a2", "b0"]


def test_slice_without_key_follows_file_order(spark, tmp_path):
    from sparkfolio.operators.rows import slice_rows
    _w(tmp_path / "a.csv", "k\n" + "".join(f"a{i}\n" for i in range(3)))
    _w(tmp_path / "b.csv", "k\n" + "".join(f"b{i}\n" for i in range(40)))
    df = spark.read.option("header", True).csv(str(tmp_path))
    assert [r.k for r in slice_rows(df, 1, 5).collect()] == ["a1", "a2", "b0", "b1"]


def test_fifty_headers_in_one_scan(spark, tmp_path):
    """Each file has its own columns in its own order; quoted names, short
    rows, blank lines before the header, a file that is empty and one with
    nothing but a header; names that one file alone has."""
    import random
    r = random.Random(7)
    names = [f"c {i}" for i in range(12)] + ['quoted, name', "größe"]
    want = []
    for f in range(50):
        mine = r.sample(names, r.randrange(1, len(names))) + [f"only {f}"]
        lines = [",".join(f'"{n}"' if "," in n else n for n in mine)]
        for i in range(r.randrange(0, 5)):
            cells = [f"{f}.{i}.{n}" for n in range(len(mine))]
            cells = cells[:r.randrange(1, len(cells) + 1)]
            lines.append(",".join(f'"{c},"' if k % 3 == 1 else c for k, c in enumerate(cells)))
            cells = [c + "," if k % 3 == 1 else c for k, c in enumerate(cells)] + [""] * (len(mine) - len(cells))
            want.append(tuple(sorted(zip(mine, cells))))
        _w(tmp_path / f"part_{f:02}.csv", "\n" * (f % 3) + "\n".join(lines) + "\n")
    _w(tmp_path / "part_99.csv", "")
    df = R.read_csv_glob(spark, [str(tmp_path / "part_*.csv")], all_string=True, position_col="_at")
    assert set(df.columns) == set(names) | {f"only {f}" for f in range(50)} | {"_at"}
    got = [tuple(sorted((c, v) for c, v in row.asDict().items() if v is not None and c != "_at")) for row in df.collect()]
    assert sorted(got) == sorted(want)
    plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "FileScan text" not in plan
    # one column: the scan parses that column's places alone
    narrow = df.select("größe")._jdf.queryExecution().executedPlan().toString()
    places = {h.index("größe") for h in (open(tmp_path / f"part_{f:02}.csv", encoding="utf-8").read().split("\n")[f % 3].replace('"quoted, name"', "q").split(",") for f in range(50)) if "größe" in h}
    assert set(re.findall(r"_c(\d+)#", narrow)) == set(map(str, places))


def test_rows_equal_to_the_header_stay_and_large_files_are_split(spark, tmp_path):
    """Headers of files whose splits have a task each are found though tasks
    stop early, and each file's rows are read by them."""
    n = 60_000
    _w(tmp_path / "p_a.csv", "k,v\n" + "".join(f"a{i},{i}\n" for i in range(n)) + "k,v\n")
    _w(tmp_path / "p_b.csv", "v,k,w\n" + "".join(f"{i},b{i},x\n" for i in range(n)))
    _w(tmp_path / "p_c.csv", "w\n1\n")
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        df = R.read_csv_glob(spark, [str(tmp_path / "p_*.csv")])
        assert df.rdd.getNumPartitions() > 15
        got = df.agg(F.count("k").alias("k"), F.sum(F.expr("try_cast(v as long)")).alias("v"), F.count("w").alias("w"), F.count_if(F.col("k") == "k").alias("h")).first()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert tuple(got) == (2 * n + 1, n * (n - 1), n + 1, 1)
    assert R._conf_bytes(spark, "spark.sql.files.maxPartitionBytes") == 128 << 20


def test_no_files_and_one_header_file(spark, tmp_path):
    assert R.read_csv_by_name(spark, str(tmp_path / "x*.csv")) is None
    _w(tmp_path / "x.csv", "a,b,a\n1,2,3\n4\n")
    assert [tuple(r) for r in R.read_csv_by_name(spark, str(tmp_path / "x*.csv")).collect()] == [("1", "2"), ("4", None)]
    _w(tmp_path / "x.csv", "")
    empty = R.read_csv_by_name(spark, str(tmp_path / "x*.csv"))
    assert empty.columns == [] and empty.count() == 0
