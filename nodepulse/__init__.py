"""nodepulse: telemetry analytics for a large machine room, as Spark DataFrame jobs.

Packages
--------
functions  column expressions (time grid, missing-value rules, bands, places)
operators  DataFrame -> DataFrame steps (aggregation, interval joins, edges, ...)
sources    readers, writers and schemas
streaming  Structured Streaming forms of the first two aggregation steps
plans      operators chained into whole jobs, and the registry of checked queries
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few pandas functions travel to the executors with their code, so nothing
# has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
