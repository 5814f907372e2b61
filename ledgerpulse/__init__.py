"""Payment-telemetry analytics as PySpark jobs.

Tables are DataFrames, operators are functions from DataFrames to DataFrames,
and every operator that has a single-key form also has an all-keys form.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers travel by value, so executors need no copy
# of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
