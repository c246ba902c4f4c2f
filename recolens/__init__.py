"""Recommendation analytics on Spark DataFrames.

Every operator takes and returns DataFrames. No module here creates a session;
the caller passes one in or it is taken from the input DataFrame.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their tasks, so the package need
# not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
