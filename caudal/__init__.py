"""caudal: a PySpark-native engine for public-works, budget and contract data, and for text corpora."""

import sys

from pyspark import cloudpickle

# Functions that Spark sends to Python workers travel whole, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
