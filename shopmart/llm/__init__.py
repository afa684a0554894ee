"""Training-data operators: dedup, cleaning, classification, formatting, mixing.

Nothing else in the library imports this subpackage.  Its functions are
shipped to the workers by value, so a cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
