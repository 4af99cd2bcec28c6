"""Spark-native signals from dumps of short social posts.

Every operator is a function from DataFrame to DataFrame or from Column to
Column, meant to be chained with ``DataFrame.transform``.
"""

import sys

from pyspark import cloudpickle

# Helpers that run inside Arrow functions travel by value, so executors do not
# need this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
