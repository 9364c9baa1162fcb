"""Operators of a training-data pipeline. Nothing outside of this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Tasks carry these modules' functions themselves: executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
