"""Operators for training-data pipelines: one module per operator.

Nothing else in the library imports this subpackage. Functions that run in tasks are
shipped by value, so that executors need no copy of it; ``--py-files`` works as well.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
