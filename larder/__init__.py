"""Feature-store and recommendation-data jobs expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few helpers that run in Python workers travel with their tasks, so the
# executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
