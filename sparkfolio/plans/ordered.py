"""A sorted output, checked by the places that its files give."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfolio.plans.registry import query
from sparkfolio.plans.stages import landed
from sparkfolio.sources.ordered import read_ordered, write_ordered
from sparkfolio.sources.tables import load


@query("ordered_output", """
SELECT o_orderkey, o_custkey, CAST(ROW_NUMBER() OVER (ORDER BY o_orderdate, o_totalprice DESC, o_orderkey) - 1 AS BIGINT) AS place FROM orders""")
def ordered_output(spark, sf):
    """All orders by date, dearest first: written sorted once, read back with
    each row's place among the files."""
    def write(path: str) -> None:
        orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
        write_ordered(orders, path, ["o_orderdate", F.desc("o_totalprice"), "o_orderkey"])

    return read_ordered(spark, landed(spark, sf, "orders-by-date", ["orders"], write)).select("o_orderkey", "o_custkey", "place")
