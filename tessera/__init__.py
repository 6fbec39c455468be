"""tessera: a Spark-native engine that consolidates many small metadata files
into one keyed, multi-table catalog and keeps it consistent as files arrive.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins; the driver only holds specs, column lists and per-partition
statistics.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run inside tasks (mapInPandas bodies) are
# shipped by value, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from tessera.session import get_spark, work_path  # noqa: E402

__all__ = ["get_spark", "work_path"]
