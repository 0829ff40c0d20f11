"""Operators for large training-data pipelines.

Functions that run inside tasks travel with them by value, so executors need the
libraries these operators use but no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
