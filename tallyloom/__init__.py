"""A Spark-first engine for customer, money and text data."""

import sys

from pyspark import cloudpickle

#: Functions go to executors with their code, so that these need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
