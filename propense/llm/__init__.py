"""Operators for preparing training text: one module per operator, their queries in ``queries``."""

import sys

from pyspark import cloudpickle

# Functions travel to the tasks with the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
