"""Operators of a large-scale training-data pipeline, as Spark jobs.

One module per operator.  Functions that run in Python workers are pickled by
value, so executors need only the public libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
