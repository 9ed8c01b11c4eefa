"""Fact tables to ranked, prompt-ready context, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are sent along with the job, so that a
# cluster needs no copy of this package on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
