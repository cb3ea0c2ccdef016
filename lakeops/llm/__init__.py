"""Operators of a training-data pipeline: filters, deduplication, mixing, tokens, packing, archives.

Nothing outside this package imports it. Functions that run inside Python tasks are pickled by
value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
