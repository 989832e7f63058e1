"""Operators for preparing training data, on DataFrames of documents and pages.

Functions go to executors by value, so the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
