"""Operators for preparing training data: toxicity, decontamination, page text,
licences, BPE, web-archive revisits, vector search, chat repair, language
identification and the shingle similarity join.

Nothing else in the library imports this subpackage; ``queries`` registers one
query per operator and ``corpus_pipeline`` (repository top) chains five of them.
"""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with the job, so executors need the
# public libraries only, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
