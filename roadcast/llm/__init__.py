"""Operators for preparing training text at scale.

Ten operators, each in a module of its own with a general interface (DataFrame
in, DataFrame out); ``queries`` holds the thin registered queries on top of
them.  Nothing else in the library imports this package.

Functions that run in Python workers are sent by value, so executors need the
installed packages only, not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
