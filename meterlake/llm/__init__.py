"""Operators for building training corpora; nothing else in the package imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions go to the executors by value, so that those need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
