"""Operators of a training-data pipeline: dedup, scans, mixing, quality, formatting, search, packing.

Nothing outside this folder imports it; ``queries`` registers one query per operator.
"""

import sys

from pyspark import cloudpickle

# As in the package above: functions that run inside tasks travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
