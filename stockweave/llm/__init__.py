"""Operators for training-data pipelines, and the queries that apply them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so a job does not need
# the package installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
