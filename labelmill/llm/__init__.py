"""Operators for preparing training text: dedup, scoring, mixing, sharding.

Nothing else in the library imports this package. Its Python functions travel
to the workers as code, which need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
