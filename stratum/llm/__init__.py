"""Operators for preparing training text at scale.

Nothing outside this package (and ``corpus_pipeline.py``) imports it; general
helpers come from the rest of the library.
"""

import sys

from pyspark import cloudpickle

# Tasks carry this package's functions themselves, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
