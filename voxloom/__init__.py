"""voxloom: a Spark-native engine for curating speech and text corpora.

Every operator takes and returns DataFrames.  Python functions that run on
executors are pickled by value, so workers need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
