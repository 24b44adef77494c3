"""Operators of a training-data pipeline; nothing else in the library imports this package.

Functions of this package run inside tasks. They are sent to the executors by value, so that executors
need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
