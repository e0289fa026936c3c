"""Operators for training-data pipelines; nothing outside this folder imports them."""

import sys

from pyspark import cloudpickle

# What tasks run travels with them: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
