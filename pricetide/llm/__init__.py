"""Training-data operators: mixing, decontamination, near-duplicates, WARC,
vector search, toxicity, language id, chat formatting, secret scans and URL
filters. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a cluster
# needs no copy of the package beside the driver's.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
