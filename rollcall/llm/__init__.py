"""Operators of a training-data pipeline, and their registered queries.

Nothing else in the library imports this package. Its functions travel to the executors by
value, so that they need no copy of the library there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
