"""Operators for preparing training data: quality, language, duplicates, leaks, models, packing and token files."""

import sys

from pyspark import cloudpickle

# Functions go to Python workers as code, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
