"""Relational operators over corpora, token streams, manifests and logs."""

import sys

from pyspark import cloudpickle

# functions of this package are sent to Python workers by value: executors need not have the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
