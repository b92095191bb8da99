"""Operators for large training corpora (filters, dedup, PII, packing, ...).

Nothing else in the library imports this subpackage. Functions that run inside Spark tasks are
pickled by value, so executors do not need the package installed on their Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
