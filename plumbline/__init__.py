"""Plumbline: a Spark-first engine for catalogue snapshots, evidence documents and their facts."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers receive the functions of this package by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
