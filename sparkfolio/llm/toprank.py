"""The first rows of each group, without a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD = 64


def top_rows(rows: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group with their ``rank`` (from 1).

    Each group is ranked in SPREAD hashed parts first, so the task that ranks
    the whole group reads SPREAD * k rows of it at most."""
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD))
    some = rows.withColumn("_salt", salt).withColumn(rank, F.row_number().over(Window.partitionBy(*group, "_salt").orderBy(*order)))
    some = some.where(F.col(rank) <= k).drop("_salt", rank)
    return some.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= k)
