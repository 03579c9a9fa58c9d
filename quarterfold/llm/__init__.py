"""Operators of a training-data pipeline over documents, pages and benchmark items. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
