"""Event-to-retrieval analytics as plain PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Arrow batch functions travel to the tasks with their code, so
# executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
