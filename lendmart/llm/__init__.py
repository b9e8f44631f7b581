"""Operators for preparing training text. Nothing else in the library imports this.

Functions that run in tasks travel with the job, so executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
