"""Operators for preparing training text: near-duplicates, quality, extraction, filters, packing, scans, counts.

Functions that run in Python workers are sent to them by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
