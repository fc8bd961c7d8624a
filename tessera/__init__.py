"""tessera: Spark-native file profiling and run comparison.

Every public function is DataFrame -> DataFrame (or writes a DataFrame to a
sink).  The central intermediate form is the long ``cells`` DataFrame
``(file_name, row_no, ordinal, column, value)``: one row per input cell, so a
single partial+final hash aggregation profiles every column of every file.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

# Functions shipped to Python workers (mapInPandas, foreachPartition) are
# pickled by value, so executors need no installed copy of this package and
# the driver's working directory does not matter.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

from tessera.session import build_session, shared_dir  # noqa: E402

__all__ = ["build_session", "shared_dir"]
