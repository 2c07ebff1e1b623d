"""Operators of a training-data pipeline; nothing else in the library imports them.

Task functions of this subpackage travel to the executors by value, so these
need the libraries named in the README but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
