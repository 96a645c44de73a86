"""Operators over documents, embeddings and pages for the making of training data."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, which so
# need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
