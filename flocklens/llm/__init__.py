"""Operators of a training-data pipeline over the tables documents, embeddings and pages.

Each module holds one operator with its own general interface; ``queries``
holds the thin registered queries over them. Nothing outside this subpackage
imports it.
"""

import sys

from pyspark import cloudpickle

# tasks get the functions themselves: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
