"""Operators that prepare documents, pages and vectors as training data."""

import sys

from pyspark import cloudpickle

# Ship the functions that run in tasks, so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
