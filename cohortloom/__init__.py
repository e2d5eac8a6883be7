"""Cohort analytics on Spark: entities with text, recordings and signals."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
