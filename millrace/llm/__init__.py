"""Operators for preparing language-model training data at scale.

Nothing else in the library imports this subpackage. Every operator takes and returns
DataFrames, keeps its own general interface, and states in its docstring what it does with
nulls, empty texts, ties and repeated rows.
"""

import sys

from pyspark import cloudpickle

# The functions that run in tasks travel with the tasks, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
