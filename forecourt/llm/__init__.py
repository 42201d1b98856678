"""Operators for preparing language-model training data: one module per operator."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
