"""Operators for building training data from documents and web pages, with their queries."""

import sys

from pyspark import cloudpickle

# Executors get the functions of this package with the task, without an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
