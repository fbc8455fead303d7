"""Mini-engine surface on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfolio.functions.arith import round_half, round_sql
from sparkfolio.operators.frame import Frame
from sparkfolio.plans.registry import query
from sparkfolio.plans.stages import stage
from sparkfolio.sources.tables import load

HIGH_VALUE = 50000.0  # P10 mask threshold on l_extendedprice


def facade_flow(spark, sf):
    """The load -> add column -> mask -> join -> group flow, written exactly as
    a user of the facade writes it (one row per order line reaches the join)."""
    details = Frame(load(spark, sf, "lineitem")
                    .select("l_orderkey", "l_extendedprice", "l_quantity"))
    details["tax"] = details["l_extendedprice"] * 0.1
    high = details[details["l_extendedprice"] > HIGH_VALUE]
    orders = Frame(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus"))
    merged = orders.join(high, left_on="o_orderkey", right_on="l_orderkey")
    stats = merged.groupby(["o_orderstatus"]).agg(
        {"tax": "sum", "l_extendedprice": "avg", "l_quantity": "max", "o_orderkey": "count"})
    # a sum of 4-decimal values has 4 decimals: rounding there removes summation-order noise
    return stats.df.withColumn("tax_sum", round_half("tax_sum", 4))


_FLAGSHIP_SQL = f"""
SELECT o.o_orderstatus,
       {round_sql("SUM(CAST(ROUND(l.l_extendedprice * 0.1 * 10000.0) AS BIGINT)) / 10000.0", 5)} AS tax_sum,
       {round_sql('AVG(l.l_extendedprice)', 4)} AS l_extendedprice_avg,
       MAX(l.l_quantity) AS l_quantity_max,
       COUNT(*) AS o_orderkey_count
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_extendedprice > {HIGH_VALUE}
GROUP BY o.o_orderstatus
"""

_FACADE_SQL = f"""
SELECT o.o_orderstatus,
       {round_sql(f"SUM({round_sql('l.l_extendedprice * 0.1', 4)})", 4)} AS tax_sum,
       {round_sql('AVG(l.l_extendedprice)', 4)} AS l_extendedprice_avg,
       MAX(l.l_quantity) AS l_quantity_max,
       COUNT(*) AS o_orderkey_count
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_extendedprice > {HIGH_VALUE}
GROUP BY o.o_orderstatus
"""
SALT = 64


@query("tax_filter_join_agg", _FLAGSHIP_SQL)
def tax_filter_join_agg(spark, sf):
    """Flagship (C2, P10, J1, A1) with eager aggregation below the join.

    Order lines are reduced to one row per order *before* the join: the
    partial aggregate combines map-side (a hot order key collapses to one row
    per task), the shuffle carries at most one row per order, and the join
    reuses that hash partitioning so only ``orders`` is exchanged again.
    The tax (C2: price x 0.1 rounded to 4 places) is summed exactly as
    integer ten-thousandths: 64-bit sums per order and per hash bucket of the
    order key (no partial can overflow, a hot status is split), then the
    bucket partials are added as DECIMAL.
    """
    tax_units = F.round(F.col("l_extendedprice") * F.lit(0.1) * F.lit(10000.0)).cast("bigint")
    li = (load(spark, sf, "lineitem")
          .where(F.col("l_extendedprice") > F.lit(HIGH_VALUE))
          .select("l_orderkey", "l_extendedprice", "l_quantity", tax_units.alias("tax_u")))
    per_order = li.groupBy("l_orderkey").agg(
        F.sum("tax_u").alias("s_tax"), F.sum("l_extendedprice").alias("s_price"),
        F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("mx_qty"))
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    j = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "inner")
    part = j.groupBy("o_orderstatus", F.pmod(F.xxhash64("o_orderkey"), F.lit(SALT)).alias("_b")).agg(
        F.sum("s_tax").alias("s_tax"), F.sum("s_price").alias("s_price"),
        F.sum("n").alias("n"), F.max("mx_qty").alias("mx_qty"))
    tax_total = F.sum(F.col("s_tax").cast("decimal(38,0)"))
    return part.groupBy("o_orderstatus").agg(
        round_half((tax_total / F.lit(10000)).cast("double"), 5).alias("tax_sum"),
        round_half(F.sum("s_price") / F.sum("n"), 4).alias("l_extendedprice_avg"),
        F.max("mx_qty").alias("l_quantity_max"),
        F.sum("n").alias("o_orderkey_count"))


query("facade_flow", _FACADE_SQL)(facade_flow)


@query("project_filter_ops", """
SELECT o_orderkey, okey_text, o_orderstatus, o_totalprice, o_orderpriority
FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS okey_text, o_orderstatus,
             o_totalprice, o_orderpriority FROM orders) t
WHERE o_totalprice >= 100000
  AND o_orderstatus <> 'P'
  AND o_orderpriority <= '3-MEDIUM'
  AND TRY_CAST(okey_text AS DOUBLE) < 12000
""")
def project_filter_ops(spark, sf):
    """P1, P9 (numeric literal given as text, != on text, string order),
    C1 (numeric comparison on a text column)."""
    o = Frame(load(spark, sf, "orders")
              .select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))
    o["okey_text"] = F.col("o_orderkey").cast("string")
    o = o.select(["o_orderkey", "okey_text", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    o = o.filter("o_totalprice", ">=", "100000")
    o = o.filter("o_orderstatus", "!=", "P")
    o = o.filter("o_orderpriority", "<=", "3-MEDIUM")
    o = o.filter("okey_text", "<", "12000")
    return o.df


@query("head_slice", """
SELECT o_orderkey, o_totalprice, row_idx FROM (
  SELECT o_orderkey, o_totalprice,
         ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS row_idx,
         COUNT(*) OVER () AS n
  FROM orders) t
WHERE row_idx >= 100 AND row_idx < n - 100 AND (row_idx - 100) % 7 = 0
""")
def head_slice(spark, sf):
    """O2 + O5: rows[100:-100:7] in key order, with the dense index kept."""
    from sparkfolio.operators.rows import slice_rows
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return slice_rows(o, 100, -100, 7, order_by=["o_orderkey"], keep_index=True, ordered=False)


@query("slice_reverse", """
SELECT o_orderkey, row_idx FROM (
  SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS row_idx,
         COUNT(*) OVER () AS n
  FROM orders) t
WHERE row_idx <= n - 1 - 10 AND row_idx > 50 AND ((n - 1 - 10) - row_idx) % 13 = 0
""")
def slice_reverse(spark, sf):
    """O2 with a negative start and step: rows[-11:50:-13]."""
    from sparkfolio.operators.rows import slice_rows
    o = load(spark, sf, "orders").select("o_orderkey")
    return slice_rows(o, -11, 50, -13, order_by=["o_orderkey"], keep_index=True, ordered=False)


@query("head_rows", """
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def head_rows(spark, sf):
    """O1: head(10) of a keyed order (top-k: TakeOrderedAndProject)."""
    o = Frame(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"))
    return o.head(10, order_by=[F.col("o_totalprice").desc(), "o_orderkey"]).df


@query("drop_add_columns", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       'orders' AS source,
       0 AS o_discount,
       {round_sql('o_totalprice / 1000.0', 4)} AS price_k,
       o_totalprice + 1.0 AS price_plus,
       o_totalprice - 1.0 AS price_minus
FROM orders
""")
def drop_add_columns(spark, sf):
    """P3 drop, P5/P8 literal column, P7 missing column default 0, C2 / + -."""
    o = Frame(load(spark, sf, "orders"))
    o = o.drop(["o_orderpriority"])
    o["source"] = "orders"
    for c in ["o_discount"]:
        if c not in o.columns:
            o[c] = F.lit(0)
    o["price_k"] = o["o_totalprice"] / 1000
    o["price_plus"] = o["o_totalprice"] + 1
    o["price_minus"] = o["o_totalprice"] - 1
    return o.df


@query("group_all_aggs", f"""
SELECT l_returnflag, l_linestatus,
       COALESCE(SUM(l_quantity), 0) AS l_quantity_sum,
       {round_sql('AVG(l_extendedprice)', 4)} AS l_extendedprice_avg,
       MIN(l_discount) AS l_discount_min,
       MAX(l_tax) AS l_tax_max,
       COUNT(*) AS l_orderkey_count,
       COALESCE(SUM(TRY_CAST(qty_text AS DOUBLE)), 0) AS qty_text_sum
FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS qty_text FROM lineitem) t
GROUP BY l_returnflag, l_linestatus
""")
def group_all_aggs(spark, sf):
    """A1: every aggregate of the facade, incl. a text column parsed per value."""
    li = load(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_orderkey",
        F.col("l_quantity").cast("bigint").cast("string").alias("qty_text"))
    g = Frame(li).groupby(["l_returnflag", "l_linestatus"]).agg({
        "l_quantity": "sum", "l_extendedprice": "avg", "l_discount": "min",
        "l_tax": "max", "l_orderkey": "count", "qty_text": "sum"})
    return g.df


@query("membership_semi", f"""
SELECT l_returnflag, COUNT(*) AS n_lines,
       {round_sql('SUM(l_extendedprice)', 3)} AS sum_price
FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))
GROUP BY l_returnflag
""")
def membership_semi(spark, sf):
    """P12 (+ P13): membership in a derived key set as a left-semi join."""
    from sparkfolio.operators.frame import keep_members
    urgent = keep_members(load(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice")
    m = keep_members(li, "l_orderkey", urgent.select("o_orderkey"))
    return m.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"),
                                         round_half(F.sum("l_extendedprice"), 3).alias("sum_price"))


@query("party_union", """
SELECT * FROM (
  SELECT c_custkey AS party_id, 'customer' AS kind, c_acctbal AS acctbal, c_mktsegment AS segment,
         CAST(NULL AS INTEGER) AS nationkey_s FROM customer
  UNION ALL
  SELECT s_suppkey, 'supplier', s_acctbal, NULL, s_nationkey FROM supplier) t
""")
def party_union(spark, sf):
    """UNION ALL by column name, absent columns NULL (P6 renames)."""
    from sparkfolio.sources.readers import union_by_name
    c = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_id"), F.lit("customer").alias("kind"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("party_id"), F.lit("supplier").alias("kind"),
        F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey_s"))
    return union_by_name([c, s])


@query("csv_landing", f"""
SELECT o_orderpriority, COUNT(*) AS o_orderkey_count,
       {round_sql('AVG(o_totalprice)', 4)} AS o_totalprice_avg,
       MAX(CAST(o_custkey AS DOUBLE)) AS o_custkey_max
FROM orders GROUP BY o_orderpriority
""")
def csv_landing(spark, sf):
    """S11 + S3 + S1 + A1 on whole tables: orders landed as header CSV part
    files, read back by glob as all-string columns, aggregated by the facade
    with per-value number parsing."""
    import os
    from sparkfolio.plans.stages import landed_csv
    from sparkfolio.sources.readers import read_csv_glob
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    path = landed_csv(spark, sf, "orders_csv", ["orders"],
                      lambda: load(spark, sf, "orders").select(*cols))
    raw = read_csv_glob(spark, [os.path.join(path, "part-*.csv")], all_string=True,
                        same_header=True)
    g = Frame(raw).groupby(["o_orderpriority"]).agg(
        {"o_orderkey": "count", "o_totalprice": "avg", "o_custkey": "max"})
    return g.df


@query("slice_keyless", """
SELECT l_orderkey, l_linenumber, l_extendedprice, row_idx FROM (
  SELECT l_orderkey, l_linenumber, l_extendedprice, ROW_NUMBER() OVER () - 1 AS row_idx FROM lineitem) t
WHERE row_idx >= 3
""")
def slice_keyless(spark, sf):
    """O2 + O5 without a key: rows[3:] in file order, with the index kept."""
    from sparkfolio.operators.rows import slice_rows
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return slice_rows(li, 3, None, keep_index=True, ordered=False)


def build_row_values(spark, sf):
    """A table with one row a lineitem row, in its order: a flag and a number
    that hang on the row and on its place."""
    from sparkfolio.operators.rows import with_row_index
    li = with_row_index(load(spark, sf, "lineitem").select("l_linenumber", "l_quantity"), name="i")
    place = F.col("i") + F.col("l_linenumber")
    return li.select("i", (place % 3 != 1).alias("flag"), (place * 2).alias("twice")).orderBy("i").drop("i")


def _row_values(spark, sf) -> Frame:
    return Frame(stage(spark, sf, "row_values", ["lineitem"], lambda: build_row_values(spark, sf)))


@query("list_mask", """
SELECT l_orderkey, l_linenumber, l_quantity FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, ROW_NUMBER() OVER () - 1 AS i FROM lineitem) t
WHERE (i + l_linenumber) % 3 <> 1
""")
def list_mask(spark, sf):
    """P10 with a mask from another table, matched by row position."""
    f = Frame(load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))
    return f[_row_values(spark, sf).rows("flag")].df


@query("list_column", """
SELECT l_orderkey, l_linenumber, CAST((ROW_NUMBER() OVER () - 1 + l_linenumber) * 2 AS BIGINT) AS twice FROM lineitem
""")
def list_column(spark, sf):
    """P5 with the values of another table's column, one a row by position."""
    f = Frame(load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))
    f["twice"] = _row_values(spark, sf).rows("twice")
    return f.df


_COMPARED = {"==": 1993.02, "!=": 1993.02, "<": 60000, "<=": 60000.0, ">": "150000", ">=": 150000.5}


@query("comparators", """
SELECT 'o_totalprice' AS column_name, op, CAST(SUM(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS n FROM (
  SELECT op, CASE op WHEN '==' THEN o_totalprice = 1993.02 WHEN '!=' THEN o_totalprice <> 1993.02 WHEN '<' THEN o_totalprice < 60000 WHEN '<=' THEN o_totalprice <= 60000
                     WHEN '>' THEN o_totalprice > 150000 ELSE o_totalprice >= 150000.5 END AS hit
  FROM orders, (VALUES ('=='), ('!='), ('<'), ('<='), ('>'), ('>=')) t(op)) x GROUP BY op
UNION ALL
SELECT 'o_orderstatus', op, CAST(SUM(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) FROM (
  SELECT op, CASE op WHEN '==' THEN o_orderstatus = 'O' WHEN '!=' THEN o_orderstatus <> 'O' WHEN '<' THEN o_orderstatus < 'O' WHEN '<=' THEN o_orderstatus <= 'O'
                     WHEN '>' THEN o_orderstatus > 'O' ELSE o_orderstatus >= 'O' END AS hit
  FROM orders, (VALUES ('=='), ('!='), ('<'), ('<='), ('>'), ('>=')) t(op)) x GROUP BY op
""")
def comparators(spark, sf):
    """P11 + P9: all six comparisons of a number column (with numbers and with
    a number as text) and of a text column, counted in the masks and filters
    of one scan each."""
    o = Frame(load(spark, sf, "orders").select("o_totalprice", "o_orderstatus"))
    c = o["o_totalprice"]
    masks = [c == _COMPARED["=="], c != _COMPARED["!="], c < _COMPARED["<"], c <= _COMPARED["<="], c > _COMPARED[">"], c >= _COMPARED[">="]]
    price = {op: m.expr for op, m in zip(_COMPARED, masks)}
    status = {op: o.predicate("o_orderstatus", op, "O") for op in _COMPARED}
    counts = o.df.agg(*[F.count_if(m).alias(f"p{i}") for i, m in enumerate(price.values())], *[F.count_if(m).alias(f"s{i}") for i, m in enumerate(status.values())])
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(op).alias("op"), F.col(f"{p}{i}").alias("n"))
             for c, p, of in (("o_totalprice", "p", price), ("o_orderstatus", "s", status)) for i, op in enumerate(of)]
    return counts.select(F.inline(F.array(*cells)))


_ODD_VALUES = """
SELECT l_returnflag, l_linenumber, l_orderkey,
       CASE l_linenumber WHEN 1 THEN 1e-9 WHEN 2 THEN 9e28 WHEN 3 THEN 9e30 ELSE l_quantity END AS v
FROM lineitem"""


@query("sum_sizes", f"""
WITH t AS ({_ODD_VALUES})
SELECT l_linenumber, COUNT(*) AS l_orderkey_count, CAST(SUM(l_orderkey) AS DOUBLE) AS l_orderkey_sum,
       {round_sql("SUM(v) / (CASE l_linenumber WHEN 1 THEN 1e-9 WHEN 2 THEN 9e28 WHEN 3 THEN 9e30 ELSE 1.0 END)", 3)} AS units
FROM t GROUP BY l_linenumber
""")
def sum_sizes(spark, sf):
    """A1 ``sum`` of tiny and of huge values, in units of the value, and of whole numbers."""
    n = F.col("l_linenumber")
    unit = F.when(n == 1, 1e-9).when(n == 2, 9e28).when(n == 3, 9e30)
    li = load(spark, sf, "lineitem").select("l_linenumber", "l_orderkey", F.coalesce(unit, "l_quantity").alias("v"))
    g = Frame(li).groupby(["l_linenumber"]).agg({"l_orderkey": "count", "v": "sum"}).df
    keys = Frame(li).groupby(["l_linenumber"]).agg({"l_orderkey": "sum"}).df
    return (g.join(keys, "l_linenumber")
            .select("l_linenumber", "l_orderkey_count", "l_orderkey_sum", round_half(F.col("v_sum") / F.coalesce(unit, F.lit(1.0)), 3).alias("units")))


@query("code_padding", """
SELECT o_orderkey, CASE WHEN length(code) < 6 THEN lpad(code, 6, '0') ELSE code END AS code,
       CAST(o_custkey AS DOUBLE) AS number FROM (
  SELECT o_orderkey, o_custkey, CAST(o_orderkey * (CASE WHEN o_orderkey % 2 = 0 THEN 1000003 ELSE 1 END) AS VARCHAR) AS code FROM orders) t
""")
def code_padding(spark, sf):
    """C12 on codes of one to over six characters, and C1 on numbers with white space around them."""
    from sparkfolio.functions.coerce import try_num, zero_pad
    code = (F.col("o_orderkey") * F.when(F.col("o_orderkey") % 2 == 0, 1000003).otherwise(1)).cast("string")
    return load(spark, sf, "orders").select(
        "o_orderkey", zero_pad(F.concat(F.lit(" "), code, F.lit("\t"))).alias("code"),
        try_num(F.concat(F.lit("\t\n"), F.col("o_custkey").cast("string"), F.lit("\u00a0"))).alias("number"))


@query("keep_first_missing", """
SELECT l_suppkey, l_partkey, l_orderkey, ord FROM (
  SELECT l_suppkey, l_partkey, l_orderkey, ord,
         ROW_NUMBER() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY ord NULLS LAST) AS k,
         COUNT(*) OVER (PARTITION BY l_suppkey, l_partkey) AS n,
         COUNT(*) OVER (PARTITION BY l_suppkey, l_partkey, ord) AS ties
  FROM (SELECT l_suppkey, l_partkey, l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey * 10 + l_linenumber END AS ord FROM lineitem) x) t
WHERE k = 1 AND (ord IS NOT NULL OR n = 1)
""")
def keep_first_missing(spark, sf):
    """W3 where half of the order values are missing: they come last, and a key
    with nothing else keeps a whole row (checked where it has one row)."""
    from sparkfolio.operators.rows import keep_first
    li = load(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", F.when(
        F.col("l_orderkey") % 2 == 0, F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    sizes = li.groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    first = keep_first(li, ["l_suppkey", "l_partkey"], "ord").join(sizes, ["l_suppkey", "l_partkey"])
    return first.where(F.col("ord").isNotNull() | (F.col("n") == 1)).select("l_suppkey", "l_partkey", "l_orderkey", "ord")
