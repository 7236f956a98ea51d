"""Operators for preparing training text at scale.

Nothing else in the library imports this package.  Its functions run inside
Python workers, so the package is pickled by value: a cluster needs no copy of
it on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
