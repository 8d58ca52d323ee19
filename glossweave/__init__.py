"""Spark-native text and lexical analytics."""

import sys

from pyspark import cloudpickle

# Functions shipped to executors travel by value, so that a cluster needs no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
