"""Operators for preparing training text. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Executors get these functions by value, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
