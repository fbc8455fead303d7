"""sparkfolio: Spark-native analytics toolkit.

Every operator takes and returns a ``pyspark.sql.DataFrame`` (or a thin
lazy wrapper around one).  Nothing is computed until the caller runs an
action; Catalyst/AQE choose the physical plan.
"""

from sparkfolio.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
