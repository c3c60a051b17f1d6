"""Operators of a large training-data pipeline, one module each.

Functions that run in Spark's Python workers are shipped by value, so the package
need not be installed on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
