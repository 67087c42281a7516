"""Operators for preparing training text.  Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this subpackage by value: executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
