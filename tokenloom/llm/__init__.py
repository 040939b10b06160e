"""Training-data pipeline operators. Nothing outside this package imports it.

Functions of this package are sent to Python workers by value, so executors
need not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
