"""sessionbars: intraday bar analytics as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL built-ins, so Catalyst can prune, push down and fuse it.  The
instrument key (``symbol``) is a first-class column: one job handles every
instrument at once.
"""

from sessionbars.session import checkpoint_root, get_spark, scratch_path

__all__ = ["get_spark", "checkpoint_root", "scratch_path"]
