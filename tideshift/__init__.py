"""Regime analytics for time series, written as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code along, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
