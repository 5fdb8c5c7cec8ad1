"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Functions that run in tasks are sent to the executors whole, so a cluster needs the
third-party libraries there but no copy of this package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
