"""Spark-native building blocks for a clean, deduplicated, tokenised text corpus."""

import sys

from pyspark import cloudpickle

# Functions travel to the workers with the job, so nodes need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
