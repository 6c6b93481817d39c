"""Tutelage: the data work around teaching a small model from a large one, on Spark.

Everything is a DataFrame in and a DataFrame (or a Column) out; see README.md for the map.
"""

import sys

from pyspark import cloudpickle

# The few Python helpers travel to the workers by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
