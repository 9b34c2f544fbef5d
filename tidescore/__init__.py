"""tidescore: score tables and streams with models that arrive as data, on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so the package need not be
# installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
