"""Operators for training-data pipelines over text, vectors and web captures.

Nothing else in the library imports this package. Its functions are shipped to
the executors by value, so that only the driver needs the package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
