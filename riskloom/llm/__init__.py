"""Operators of a training-data pipeline: quality, duplicates, leaks, personal data, mixing, markup, tokens, chat.

The functions that run inside tasks are pickled by value, so workers need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
