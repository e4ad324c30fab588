"""Operators for preparing training data: each takes DataFrames and returns DataFrames."""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
