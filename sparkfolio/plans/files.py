"""File sources on the driver tables.

Each entry lands a table in the shared folder in the shape that a reader is
for (once per input version) and reads it back.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.functions.coerce import multi_format_timestamp, to_date_safe, to_number, yes_no_flag
from sparkfolio.operators.frame import Frame, columns_by_kind, present_columns
from sparkfolio.operators.segments import order_report
from sparkfolio.plans.registry import query
from sparkfolio.plans.stages import landed, landed_csv, landed_json, landed_xml, stage_root
from sparkfolio.sources import readers as R
from sparkfolio.sources.sinks import create_table_as, write_csv
from sparkfolio.sources.tables import load

EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType())])


@query("json_payload", "SELECT event_id, user_id, event_type FROM events WHERE user_id % 7 <> 0")
def json_payload(spark, sf):
    """One payload a user and day, with a status; refused ones hold nothing."""
    def payloads():
        ev = load(spark, sf, "events")
        return (ev.groupBy("user_id", F.to_date("ts").alias("day"))
                .agg(F.collect_list(F.struct("event_id", "user_id", "event_type")).alias("list"))
                .select(F.when(F.col("user_id") % 7 == 0, "013").otherwise("000").alias("status"), "list"))
    path = landed_json(spark, sf, "payloads", ["events"], payloads)
    return R.read_status_payload(spark, path, EVENT, multi_line=False)


@query("xml_companies", "SELECT CAST(s_suppkey AS VARCHAR) AS corp_code, s_name AS corp_name, lpad(CAST(s_nationkey AS VARCHAR), 6, '0') AS stock_code FROM supplier")
def xml_companies(spark, sf):
    """The company table as XML, one element a row."""
    def companies():
        return load(spark, sf, "supplier").select(
            F.col("s_suppkey").cast("string").alias("corp_code"), F.col("s_name").alias("corp_name"),
            F.lpad(F.col("s_nationkey").cast("string"), 6, "0").alias("stock_code"))
    return R.read_xml_rows(spark, landed_xml(spark, sf, "companies", ["supplier"], companies, "list"))


def _order_parts(spark, sf) -> str:
    """Two exports of orders whose columns differ in order, names and date format."""
    def write(path):
        o = load(spark, sf, "orders")
        us = o.where("o_orderkey % 2 = 0").select(
            F.col("o_orderkey").alias("Order Key"), F.date_format("o_orderdate", "M/d/yyyy h:mm:ss a").alias("Order Date"), F.col("o_totalprice").alias(" Total/Price"))
        iso = o.where("o_orderkey % 2 = 1").select(
            F.col("o_totalprice").alias(" Total/Price"), F.col("o_orderstatus").alias("Status, short"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Order Date"),
            F.col("o_orderkey").alias("Order Key"))
        write_csv(us, os.path.join(path, "us"))
        write_csv(iso, os.path.join(path, "iso"))
    return landed(spark, sf, "order_parts", ["orders"], write)


@query("csv_parts_by_name", """
SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS at, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS status
FROM orders""")
def csv_parts_by_name(spark, sf):
    """S3 + P6 + C4 + C5 + C6: parts with differing headers (a quoted one too)
    unioned by name; headers cleaned; two timestamp formats parsed."""
    raw = R.read_csv_glob(spark, [os.path.join(_order_parts(spark, sf), "*", "part-*.csv")])
    d = R.normalise_headers(raw, {"OrderKey": "o_orderkey", "Total_Price": "price", "Status,short": "status"})
    at = multi_format_timestamp("OrderDate")
    return d.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), at.cast("timestamp_ntz").alias("at"),
                    to_date_safe(F.date_format(at, "dd.MM.yyyy"), "dd.MM.yyyy").alias("day"), to_number("price").alias("price"), "status")


def _order_csv(spark, sf) -> str:
    return landed_csv(spark, sf, "orders_plain", ["orders"], lambda: load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"))


@query("csv_text", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus FROM orders")
def csv_text(spark, sf):
    """A header CSV with every column as text."""
    return Frame.read_csv(spark, _order_csv(spark, sf)).select(["o_orderkey", "o_custkey", "o_orderstatus"]).df


@query("csv_typed", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def csv_typed(spark, sf):
    """A CSV with a declared schema."""
    return R.read_csv_typed(spark, _order_csv(spark, sf), "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string")


@query("csv_optional", """
SELECT 'present' AS source, COUNT(*) AS n, MAX(o_orderkey) AS top FROM orders UNION ALL SELECT 'missing', 0, NULL""")
def csv_optional(spark, sf):
    """The first of several candidates that exists, and none of them."""
    there, schema = _order_csv(spark, sf), T._parse_datatype_string("o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string")
    found = R.read_optional_csv(spark, [there + "-not-there.csv", there], schema).select(F.lit("present").alias("source"), "o_orderkey")
    none = R.read_optional_csv(spark, [there + "-not-there.csv"], schema)
    count = lambda df, name: df.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("top"))
    return count(found, "present").unionByName(count(none, "missing"))


@query("statement_files", """
SELECT s_nationkey AS entity, 'IS' AS statement, COUNT(*) AS n, CAST(SUM(s_suppkey) AS BIGINT) AS code FROM supplier WHERE s_acctbal > 0 GROUP BY 1
UNION ALL SELECT s_nationkey, 'BS', COUNT(*), CAST(SUM(s_suppkey) AS BIGINT) FROM supplier WHERE s_acctbal <= 0 GROUP BY 1""")
def statement_files(spark, sf):
    """S6 + S9: statements landed as one set of files a kind and read back by
    the kinds' globs; the first folder has none."""
    def write(path):
        s = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("entity"), F.col("s_suppkey").alias("code"), "s_acctbal")
        write_csv(s.where("s_acctbal > 0").select("entity", F.lit("IS").alias("statement"), "code"), os.path.join(path, "all_IS_raw.csv"))
        write_csv(s.where("s_acctbal <= 0").select("code", F.lit("BS").alias("statement"), "entity"), os.path.join(path, "all_BS_raw.csv"))
    path = landed(spark, sf, "statement_files", ["supplier"], write)
    df = R.read_statement_globs(spark, [path + "-empty", path])
    return (df.groupBy(F.col("entity").cast("int").alias("entity"), "statement")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("code").cast("long")).alias("code")))


@query("table_from_query", """
SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS n, SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)::BIGINT AS purchases FROM events GROUP BY 1, 2""")
def table_from_query(spark, sf):
    """CREATE TABLE AS SELECT, then a read of the table."""
    daily = load(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("purchases"))
    create_table_as(daily, "sparkfolio_daily_events", os.path.join(stage_root(spark, "tables"), "daily_events"))
    return spark.table("sparkfolio_daily_events")


@query("frame_shape", "SELECT COUNT(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns, COUNT(*) AS length FROM orders")
def frame_shape(spark, sf):
    """A2: row count and shape."""
    f = Frame(load(spark, sf, "orders"))
    return spark.createDataFrame([(*f.shape, len(f))], "n_rows long, n_columns long, length long")


@query("column_kinds", """
SELECT t.*, CASE column_name WHEN 'o_orderkey' THEN (SELECT COUNT(o_orderkey) FROM orders) WHEN 'o_custkey' THEN (SELECT COUNT(o_custkey) FROM orders)
              WHEN 'o_totalprice' THEN (SELECT COUNT(o_totalprice) FROM orders) WHEN 'o_orderstatus' THEN (SELECT COUNT(o_orderstatus) FROM orders)
              ELSE (SELECT COUNT(o_orderdate) FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01') END AS n
FROM (VALUES ('o_orderkey', 'numeric', true), ('o_custkey', 'numeric', false), ('o_totalprice', 'numeric', true),
             ('o_orderstatus', 'categorical', true), ('late', 'categorical', false)) t(column_name, kind, wished)""")
def column_kinds(spark, sf):
    """P4 + P19 + P21: absent columns dropped without complaint, columns by
    kind with their number of values (of a boolean, the true ones), and those
    of a wish list that are there."""
    df = Frame(load(spark, sf, "orders")).drop(["o_orderpriority", "no such"], errors="ignore").df.withColumn("late", F.col("o_orderdate") > "1999-01-01")
    numeric, categorical = columns_by_kind(df)
    wished = present_columns(df, ["o_totalprice", "nothing", "o_orderstatus", "o_orderkey"])
    kinds = {**dict.fromkeys(numeric, "numeric"), **dict.fromkeys(categorical, "categorical")}
    values = df.agg(*[F.count(F.when(F.col(c), 1) if c == "late" else F.col(c)).alias(c) for c in kinds])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind"), F.lit(c in wished).alias("wished"), F.col(c).alias("n")) for c, k in kinds.items()])
    return values.select(F.inline(cells))


@query("yes_no_flags", """
SELECT l_returnflag, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 END AS flag, COUNT(*) AS n FROM lineitem GROUP BY 1, 2""")
def yes_no_flags(spark, sf):
    """Yes / No / anything else."""
    word = F.when(F.col("l_returnflag") == "A", "Yes").when(F.col("l_returnflag") == "N", "No").otherwise("yes")
    return (load(spark, sf, "lineitem").select("l_returnflag", yes_no_flag(word).alias("flag"))
            .groupBy("l_returnflag", "flag").agg(F.count(F.lit(1)).alias("n")))


@query("report_order", """
SELECT activity_level, avg_calories, ROW_NUMBER() OVER (ORDER BY avg_calories DESC, activity_level) AS place
FROM (SELECT o_orderpriority AS activity_level, CAST(MAX(o_custkey) AS BIGINT) AS avg_calories FROM orders GROUP BY 1) t""")
def report_order(spark, sf):
    """O3: a report in its ordering; the place is the row's position in it."""
    r = load(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("activity_level")).agg(F.max("o_custkey").alias("avg_calories"))
    ranked = order_report(r, "activity_levels").coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)
    return ranked
