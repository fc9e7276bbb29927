"""hazeline: Spark-native analytics for multi-station air-quality series."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel by value, so executors need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
