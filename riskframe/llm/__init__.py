"""Operators for preparing training corpora (see README, "Corpus operators").

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it. The
functions that run in Python workers are pickled by value, so that executors need only
numpy, pyarrow and the tokenizer library, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
