"""Operators for language-data pipelines. Nothing outside this package imports it.

Tasks get the package's functions by value, so a cluster needs no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
