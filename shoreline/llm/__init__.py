"""Operators of a training-data pipeline over web pages, documents and vectors.

The package is optional: nothing else in the library imports it.  Functions that
run inside Spark tasks are shipped by value, so executors need not be able to
import this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
