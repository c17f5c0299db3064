"""Operators of a training-data pipeline.

One module per operator, each with a general interface on DataFrames;
``queries`` holds the thin ``opN_<name>`` queries over the driver's tables
and their SQL.  Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Kernels travel to the executors inside the task, so that workers need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
