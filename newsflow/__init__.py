"""newsflow: a Spark library for news articles, from stored pages to batch retrieval."""

import sys

from pyspark import cloudpickle

# Arrow functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
