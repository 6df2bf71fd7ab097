"""Operators for preparing training data. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
