"""Training-data operators: search, scoring, packing, extraction, dedup, mixing, sharding."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions sent to Python workers carry their code along, so executors need no
# copy of this package.
register_pickle_by_value(sys.modules[__name__])
