"""Operators for preparing training text, and the queries that apply them to the given tables."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
