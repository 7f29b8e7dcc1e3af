"""Operators for preparing language-model training data.

Functions that run in Python workers are pickled by value, so executors need
only Python and the listed libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
