"""Operators of a training-data pipeline over documents, pages and labels.

The package's functions travel to the executors by value, so a cluster needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
