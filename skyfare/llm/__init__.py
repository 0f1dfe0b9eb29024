"""Training-data operators: language ID, decontamination, near-duplicates,
personal data, source mixing, token files, licences, vector search, toxicity
and URL reputation.  Nothing outside this subpackage imports it.

Functions of this subpackage travel to the executors by value, so a cluster
needs no copy of it there."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
