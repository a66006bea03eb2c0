"""Track-catalogue analytics, similarity and recommendation as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job: executors need numpy and pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
