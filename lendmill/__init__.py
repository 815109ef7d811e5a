"""Credit-risk analytics on Spark DataFrames: features, policy, models, explanations."""

import sys

from pyspark import cloudpickle

# Arrow functions travel with the code they call, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
