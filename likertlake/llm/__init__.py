"""Operators for training-data pipelines over text, page and vector tables.

Nothing else in the library imports this package. Functions of the package travel to
the executors by value, so a cluster needs no copy of it on its workers' import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
