"""Operators of a training-data pipeline, each over whole tables of documents, pages or vectors.

Functions that run inside tasks are shipped by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
