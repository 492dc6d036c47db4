"""Operators for building training data, and the pipeline's parts.

Functions that run in Python workers travel by value, so executors need none of
this package installed.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
