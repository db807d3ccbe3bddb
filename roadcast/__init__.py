"""roadcast: condition-aware travel analytics on Spark.

Subpackages: ``sources`` (files in/out), ``functions`` (column expressions),
``operators`` (DataFrame operators), ``plans`` (end-to-end jobs and the
registered queries).
"""

from .session import checkpoint_dir, get_spark, scratch_path

__all__ = ["checkpoint_dir", "get_spark", "scratch_path"]
