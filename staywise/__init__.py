"""Attrition analytics on Spark: cleaning, merging, features, models, explanation, monitoring.

Every operator takes and returns DataFrames and names its columns by parameter.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel by value: executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
