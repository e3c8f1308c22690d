"""Moves statistics between map areas that do not line up, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The small functions that run inside tasks travel with the job, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
