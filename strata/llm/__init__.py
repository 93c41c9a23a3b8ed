"""Operators for preparing large-scale language-model training data."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so these need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
