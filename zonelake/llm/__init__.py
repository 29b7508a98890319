"""Training-data operators: documents and web pages in, DataFrames out.

Functions that run in Python workers are shipped by value, so the workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
