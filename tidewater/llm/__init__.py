"""Operators of a training-data pipeline: deduplication, mixing, archives,
scans, filters, decontamination, chat formatting and language ID.

Functions that run inside Python workers travel by value, so executors do not
need this package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
