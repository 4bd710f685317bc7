"""Text-corpus curation as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Python functions travel to the workers by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
