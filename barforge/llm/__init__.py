"""Operators for large-scale training-data pipelines.

One module per operator; ``queries`` binds them to the given tables.  Nothing
outside this package imports it.  Functions that run on executors are shipped
by value, so executors need Spark and the installed libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
