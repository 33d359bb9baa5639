"""glebe — a Spark-native engine for property-registry loads and lookups."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the plan, so executors need this package's dependencies but not
# the package itself.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
