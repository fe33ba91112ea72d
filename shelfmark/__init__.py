"""shelfmark: catalog analytics and corpus preparation as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run on executors travel by value, so that a cluster's Python
# needs numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
