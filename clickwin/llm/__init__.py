"""Operators for training-data pipelines, one module per operator."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with the query, so
# workers need the third-party libraries but not this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
