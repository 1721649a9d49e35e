"""Operators that prepare training data from corpora of documents."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value: executors need the libraries
# these operators use, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
