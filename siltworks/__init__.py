"""siltworks: corpus curation and evaluation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so a worker needs no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
