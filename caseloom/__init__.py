"""caseloom: Spark-first analytics over semi-structured text records."""

import sys

from pyspark import cloudpickle

# Python functions travel to executors by value, so that a cluster needs no
# copy of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
