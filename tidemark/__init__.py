"""tidemark: a PySpark-native engine for event histories with knowledge time."""

import sys

from pyspark import cloudpickle

# Functions of this package that run inside Python workers travel with the
# task, so executors need no copy of the package on their own disks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
