"""Spark-first operators for building representative sets of sequences and records."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors by value, so it need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.2.0"
