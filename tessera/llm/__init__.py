"""Operators for preparing language-model training data.

Nothing outside this package (and ``corpus_pipeline.py``) imports it. Code
that runs in Python workers is shipped by value, so executors need no copy of
the package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
