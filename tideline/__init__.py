"""Market, on-chain, news and social analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so workers need not have it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
