"""Session construction and cluster-safety helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI semantics (casts and /0 raise, so the
# operators use try_cast / try_divide explicitly), UTC wall clock, and AQE for
# runtime re-planning (partition coalescing, skew-join splitting, SMJ->BHJ when
# a side turns out to be small at runtime).
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "sparkfolio",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Build (or get) a session with the toolkit's base settings.

    ``master`` is only set when given (a cluster launcher passes its own).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage and we only read it.
    Only when it is unset (local tests) do we create a scratch folder.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name shared storage on a cluster")
        cur = tempfile.mkdtemp(prefix="sparkfolio-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(cur)
    return cur


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
