"""Loader for the parquet tables of a scale-factor folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(f"unknown table {name}")
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; callers select columns so the scan prunes them and
    filters reach the reader as pushed predicates."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for t in TABLES:
        load(spark, sf_dir, t).createOrReplaceTempView(t)
