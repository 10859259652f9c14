"""Spark-native media-monitoring analytics.

Functions of this package travel to executors by value, so tasks need no installed copy of it."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
