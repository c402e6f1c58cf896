"""Grid-cell clustering of massive tables on Spark."""

import sys

from pyspark import cloudpickle

# Functions shipped to executors travel by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from .operators.recursive import RecursiveKMeans, RecursiveKMeansModel  # noqa: E402

__all__ = ["RecursiveKMeans", "RecursiveKMeansModel"]
