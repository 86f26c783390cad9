"""Operators for preparing text corpora; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Tasks get the code of this subpackage with the plan: executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
