"""Training-data operators: scans, search, dedup, language models, tokens, mixing, toxicity, archives and pages.

Nothing else in the library imports this subpackage. ``catalog`` registers one query per operator.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with their code: the library need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
