"""docloom: document-processing operators as Spark DataFrame functions.

Every operator is a plain function from DataFrames to DataFrames.  Exploded
tables (spans, cells, fields, ...) are the working form; nested documents are
assembled only where a sink needs them.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Task functions travel by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
