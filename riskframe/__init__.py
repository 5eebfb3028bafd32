"""riskframe — Spark-native analytics for tabular risk models.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql`` expressions so Catalyst can prune, push down and fuse it.
"""

from riskframe.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
