"""Operators of a training-data pipeline: filtering, deduplication, tokenizing, search and archives.

Nothing else in the library imports this package. Functions that run in Python workers are shipped by value, so
executors need only the installed libraries, not this code.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
