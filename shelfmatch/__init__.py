"""Product matching and price comparison between catalogues, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Ship the few batch functions by value, so that workers need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
