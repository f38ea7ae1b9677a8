"""Operators for training-data pipelines. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
