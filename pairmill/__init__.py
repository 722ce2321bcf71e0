"""pairmill: word co-occurrence analytics and bulk document conversion on Spark."""

import sys

from pyspark import cloudpickle

# Functions and classes of the library travel to the workers by value: it need not be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
