"""Noticeloom: announcement-link analytics and corpus preparation on PySpark."""

import sys

from pyspark import cloudpickle

# Python workers receive the package's functions by value, so a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
