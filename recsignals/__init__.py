"""recsignals: recency-aware ranking features on interaction logs, built on Spark.

Every operator is a ``DataFrame -> DataFrame`` function made of Spark SQL
expressions, aggregations, joins and windows.  Hot keys are split by time
bucket (as-of joins, range and running frames) or reduced before the shuffle
(distinct-value ranks, group statistics joined back), so no single key has to
fit in one task.
"""

from recsignals.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
