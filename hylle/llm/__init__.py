"""Operators for preparing training text; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Ship the functions' code with them: executors need no installed package, and what a
# task has in memory goes when it ends.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
