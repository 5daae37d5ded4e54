"""corvane: text, vector, classifier and matrix jobs on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Kernels that run in Python workers travel with the job, so executors need
# pyspark and numpy only, not an installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
