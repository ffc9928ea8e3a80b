"""Operators for preparing training text: filters, mixing, fingerprints, joins, models, token files, packing.

Nothing else in the library imports this package. The functions that run in Python workers
travel with the plan, so executors need no copy of it.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
