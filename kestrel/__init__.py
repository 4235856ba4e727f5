"""kestrel: geometric evaluation analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` built from
``pyspark.sql.functions``; Column-level expressions live in
``kestrel.functions``.  See README.md for the operator map.
"""

from kestrel.session import get_spark, checkpoint_dir, cut_lineage  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir", "cut_lineage"]
