"""Training-data operators: secrets, mixing, classifiers, dedup, kNN, shards, packing.

Nothing outside this package imports it.  Its modules travel to the executors
by value, so a cluster needs only the public libraries they use.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
