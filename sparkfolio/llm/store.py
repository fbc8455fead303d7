"""Tables written once in the shared folder and read back.

``saved`` cuts the lineage at a point where rows must be decided exactly once
(a lost executor then re-reads files instead of recomputing) or are read more
than once.  The folder is the one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sparkfolio.session import ensure_checkpoint_dir


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to, under the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
