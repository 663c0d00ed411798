"""corpusloom: a Spark-first engine that builds, checks and selects speech and text training corpora."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions with their tasks, so that no cluster needs it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
