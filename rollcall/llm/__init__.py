"""Operators of a training-data pipeline over the corpus tables.

Nothing outside this subpackage imports it.  Functions of these modules that
run in Spark's Python workers are shipped by value, so that executors need no
copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
