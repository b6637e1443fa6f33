"""Operators of a training-data pipeline, each built from Spark jobs.

Nothing outside this package imports it. Task functions are shipped to the
executors by value, so executors need the third-party libraries but not this
repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
