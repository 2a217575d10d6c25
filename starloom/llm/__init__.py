"""Operators of a training-data pipeline: deduplication, extraction, mixing, packing, search and scoring.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions travel to executors whole, so these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
