"""Operators of a training-data pipeline. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are sent along, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
