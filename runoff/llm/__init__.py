"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Its functions run in
executors' Python workers, so the package is pickled by value and needs no
installation there.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
