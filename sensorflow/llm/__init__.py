"""Operators for preparing a text corpus: language, toxicity, token ids,
exact and near duplicates, fingerprints, packing, licences and shards.

Every operator takes a DataFrame and column names and returns a DataFrame.
``queries`` applies them to the given tables; nothing outside this package
imports it.
"""

import sys

from pyspark import cloudpickle

# Tasks get these modules' functions by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
