"""Training-data operators: token counts, decontamination, toxicity, pseudonyms, page text, mixing, URL lists,
quality rules, sharding, near-duplicate components, fill-in-the-middle, vector codes and sentencepiece ids. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
