"""Operators for preparing training data at scale. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions that run in tasks are shipped whole, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
