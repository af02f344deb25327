"""Operators for training corpora: duplicates, private data, language, packing and the like."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the jobs that use them, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
