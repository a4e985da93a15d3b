"""Operators for preparing training data; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so that executors need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
