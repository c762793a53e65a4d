"""Operators for preparing training data; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

from .queries import ORACLES, QUERIES

# Functions of this subpackage travel to the executors with the job; they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLES", "QUERIES"]
