"""Training-data operators; nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Executors then need no copy of this package on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
