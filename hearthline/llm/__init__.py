"""Operators a training-data pipeline needs, each by one named method.

Functions of this package are sent to Python workers by value: executors need the
libraries (numpy, pandas, tokenizers, xxhash), but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
