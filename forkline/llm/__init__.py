"""Operators for training-data pipelines.  Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions go to the executors whole, so these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
