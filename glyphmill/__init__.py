"""Spark jobs that turn text corpora into token data and measure it."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers carry their helpers with them, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
