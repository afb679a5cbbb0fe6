"""Operators of a training-data pipeline: web archives, packing, line dedup,
toxicity, near-duplicates, language-model scores, BPE, quality and extraction.

Each operator is a module of its own; ``queries`` registers them.
"""

import sys

from pyspark import cloudpickle

# Task functions travel whole to the executors, which need not have this
# package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
