"""tidewell: a PySpark engine for economic and market time series.

Functions of this package that run in Python workers are sent with the job, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
