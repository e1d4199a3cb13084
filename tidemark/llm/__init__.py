"""Operators for large training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

from tidemark import session

# Worker functions travel by value, so executors need numpy, pyarrow and the named libraries, not this package.
for module in (sys.modules[__name__], session):
    cloudpickle.register_pickle_by_value(module)
