"""Operators that prepare training text. Nothing else in the library imports this package."""

from pyspark import cloudpickle

import pairmill

# Functions of the library travel to the workers by value: it need not be installed there.
cloudpickle.register_pickle_by_value(pairmill)
