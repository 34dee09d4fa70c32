"""textlode: phrase and semantic text search over DataFrames.

Everything takes and returns DataFrames or Columns.  `functions` holds
row-local Column expressions, `operators` the DataFrame operators,
`sources` readers and writers, `streaming` the incremental ingest and
`plans` whole pipelines composed from them.
"""

import sys

from pyspark import cloudpickle

# Batch functions travel to the executors by value, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
