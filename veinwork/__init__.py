"""Profile, clean, sample, encode, cluster, classify and screen wide tables with Spark."""

import sys

from pyspark import cloudpickle

# Functions that run inside Python tasks travel with the job, so that executors need pandas
# and numpy but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
