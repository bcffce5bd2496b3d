"""Data synchronisation and unified batch/stream metrics on Spark.

Layout: ``sources`` read, ``functions`` are column expressions, ``operators``
are DataFrame -> DataFrame, ``sinks`` write, ``streaming`` holds the Structured
Streaming forms, and ``plans`` puts them together.
"""

import sys

from pyspark import cloudpickle

from tidemark.session import get_session, settle, shared_folder, stage

__all__ = ["get_session", "settle", "shared_folder", "stage"]

# Functions that run inside tasks travel with the job, so that executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
