"""Operators for preparing training text: archives, quality, search, mixing, packing, near duplicates.

Functions that run in tasks are sent by value, so executors need the libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
