"""Loading and checking vector map layers with Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions and classes of this package travel to the executors whole, so
# these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
