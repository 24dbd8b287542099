"""linkwright: ingest, column profiling and record linkage as Spark jobs."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run on executors (Arrow UDFs, mapInPandas readers) travel by
# value, so workers need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__version__ = "0.1.0"
