"""Operators for training-data pipelines, one module each; ``queries`` registers them.

The package's code travels by value with the tasks that use it, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
