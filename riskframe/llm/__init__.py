"""Operators for training corpora, each a Spark job of its own; see README.

Functions of this package travel to the tasks by value, so that executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
