"""orrery: a PySpark-native library for tabular, text, feature and model work.

Every operator is a function over DataFrames (or a ``pyspark.ml`` stage), so
the heavy lifting stays inside Spark's optimizer and executors.  Sub-packages:

* ``sources``   - readers and writers (CSV variants, text, JSON, pages, sinks)
* ``functions`` - Column-expression builders (vectors, text, HTML, hashing)
* ``operators`` - DataFrame -> DataFrame operators and estimators
* ``plans``     - named queries over the test tables with oracle SQL
* ``streaming`` - Structured Streaming entry points for scoring new rows
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Kernels travel to the executors inside the task: workers need no installed
# package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
