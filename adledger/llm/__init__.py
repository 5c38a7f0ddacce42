"""Operators for large training corpora. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks whole, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
