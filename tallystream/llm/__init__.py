"""Operators of a training-data pipeline; nothing else in the package imports them.

Functions that run in tasks travel with the job, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
