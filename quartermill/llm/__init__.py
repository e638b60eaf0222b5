"""Training-data operators: search, filtering, de-duplication, tokens and chat formats.

Nothing else in the library imports this package. Its task functions are pickled
by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
