"""A PySpark-native engine for dataset preparation and entity resolution."""

import sys

from pyspark import cloudpickle

# Workers get functions by value, so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
