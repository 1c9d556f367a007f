"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  The functions that run
inside tasks are pickled by value, so executors need no copy of the library.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
