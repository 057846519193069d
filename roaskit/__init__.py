"""roaskit: marketing-performance analytics as lazy Spark DataFrame operators.

Every public operator takes DataFrames and returns a DataFrame; nothing in the
core collects data to the driver except bounded scalars (a partition count, a
d x d moment matrix, model parameters).
"""

from roaskit.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
