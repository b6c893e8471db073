"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

The functions that run inside tasks travel with their job, so that executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
