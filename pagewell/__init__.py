"""Document chunking and vector retrieval on Spark DataFrames.

Layout
------
``functions``  column expressions (text, vectors, JSON messages, embedders)
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers, landing checks, table sinks
``plans``      the ingest and retrieve dataflows, composed from the above
``streaming``  the incremental, all-or-nothing backlog drain
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python functions used inside tasks travel with the job, so executors need no
# installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
