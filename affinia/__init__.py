"""Recommender-data operators on Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

# Functions that run in Python tasks travel with the plan, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
