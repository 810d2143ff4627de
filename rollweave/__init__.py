"""Spark-first analytics over model-rollout datasets."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the plan: nothing needs to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
