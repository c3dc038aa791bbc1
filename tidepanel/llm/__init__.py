"""Operators for preparing training corpora. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
