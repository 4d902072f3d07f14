"""Operators for training data: packing, near-duplicates, extraction, scoring, token files.

The functions that run inside tasks travel with the job, so executors need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
