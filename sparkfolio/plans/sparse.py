"""One-hot and scoring by tables over orders: the customer is a category of
many values, fitted on the orders before 1997 and applied to all, so later
customers are unknown; every seventh order's priority is missing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfolio.functions.arith import round_half, round_sql
from sparkfolio.operators import sparse
from sparkfolio.plans.registry import query
from sparkfolio.sources.tables import load

FEATURES = ["customer", "priority", "status"]
INTERCEPT = -0.25

CELLS_CTE = """
WITH o AS (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS priority,
         o_orderstatus AS status, o_orderdate < TIMESTAMP '1997-01-01' AS early FROM orders),
cells AS (""" + " UNION ALL ".join(f"SELECT o_orderkey, early, {i} AS feature, {c} AS v FROM o" for i, c in enumerate(FEATURES)) + """),
n AS (SELECT feature, v, COUNT(*) AS n FROM cells WHERE early AND v IS NOT NULL GROUP BY feature, v),
slots AS (SELECT feature, v, CAST(ROW_NUMBER() OVER (ORDER BY feature, v) - 1 AS BIGINT) AS slot FROM n),
modes AS (SELECT feature, v AS mode FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY n DESC, v) AS r FROM n) q WHERE r = 1)
"""


def order_categories(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"),
                    F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("priority"), F.col("o_orderstatus").alias("status"), "o_orderdate")


def fitted(orders):
    return sparse.fit_dictionary(orders.where(F.col("o_orderdate") < F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")), FEATURES)


@query("onehot_sparse", CELLS_CTE + """
SELECT o_orderkey, COALESCE(string_agg(CAST(slot AS VARCHAR), ',' ORDER BY slot), '') AS slots
FROM cells c LEFT JOIN modes m ON c.feature = m.feature LEFT JOIN slots s ON s.feature = c.feature AND s.v = COALESCE(c.v, m.mode)
GROUP BY o_orderkey""")
def onehot_sparse(spark, sf):
    """M3-M5: every order's non-zero one-hot slots; missing priorities take the
    mode, customers unknown before 1997 have no slot."""
    orders = order_categories(spark, sf)
    return sparse.encode(orders, fitted(orders), "o_orderkey").select("o_orderkey", F.concat_ws(",", F.col("slots").cast("array<string>")).alias("slots"))


@query("score_by_slot", CELLS_CTE + f"""
SELECT o_orderkey, {round_sql("p", 9)} AS probability, CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS label
FROM (SELECT o_orderkey, CAST(1.0 AS DOUBLE) / (1.0 + EXP(-(CAST({INTERCEPT} AS DOUBLE) + COALESCE(SUM(CAST((slot * 37) % 101 - 50 AS DOUBLE) / 64.0), 0.0)))) AS p
      FROM cells c LEFT JOIN slots s ON s.feature = c.feature AND s.v = c.v GROUP BY o_orderkey) q""")
def score_by_slot(spark, sf):
    """Every order scored with a table of one weight a slot (whole
    64ths, so that sums are exact in any order); missing and unknown add nothing."""
    orders = order_categories(spark, sf)
    dictionary = fitted(orders)
    weights = dictionary.slots.select("slot", ((F.col("slot") * 37 % 101 - 50) / F.lit(64.0)).alias("weight"))
    out = sparse.score_by_slot(orders, dictionary, weights, "o_orderkey", INTERCEPT)
    return out.select("o_orderkey", round_half("probability", 9).alias("probability"), "label")
