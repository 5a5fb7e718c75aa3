"""Operators of a training-data pipeline; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# functions of this package travel to executors by value: they need not have it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
