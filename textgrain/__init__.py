"""Text-classification analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors need no installed copy of this package: the few functions that run in Python
# workers travel inside the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
