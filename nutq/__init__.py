"""Phonetic difficulty analytics for Arabic text, as native Spark expressions.

What runs inside tasks travels with them, so executors need no copy of the library.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from .config import ScoringConfig
from .plans.pipeline import score_verses
from .sources.corpus import load_corpus

__all__ = ["ScoringConfig", "load_corpus", "score_verses"]

register_pickle_by_value(sys.modules[__name__])
