"""Spark-native medallion analytics: declarative operators over the DataFrame API."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors by value, which then need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
