"""Operators for preparing language-model training data.

Nothing else in the library imports this package. Each module holds one operator
with its own general interface; ``queries.py`` holds the thin contract queries.

Python functions of this package run inside Spark tasks. They are shipped by
value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
