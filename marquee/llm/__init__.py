"""Operators for preparing language-model training data.

Nothing else in the library imports this package. Its functions travel to the Python
workers by value, so a cluster needs no copy of the package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
