"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the library imports this package.  Its functions travel to the
executors by value, so that a cluster needs no installed copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
