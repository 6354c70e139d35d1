"""Operators for preparing training text. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# functions travel to the executors as they are, so these need no copy of the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
