"""Operators for preparing training data.

Nothing else in the library imports this package. Its Python functions travel to the workers by
value, so that executors need the third-party libraries but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
