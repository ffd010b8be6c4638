"""Operators for preparing training data at scale.

Functions of this package go to executors by value, so that those need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
