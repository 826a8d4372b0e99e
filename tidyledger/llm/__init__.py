"""Operators for training-data pipelines. Nothing else in the library imports this subpackage.

Python that runs inside tasks is shipped by value, so executors need numpy, pandas and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
