"""Operators for training-data pipelines, each a function from DataFrame to DataFrame.

Functions of this subpackage travel to the executors by value, which need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
