"""Training-data operators: decontamination, suffix dedup, token output, mixing, toxicity,
exact and near dedup, token counts, sharding and URL filters.

Nothing else in the library imports this subpackage.  Its functions travel to the executors
by value, so workers need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
