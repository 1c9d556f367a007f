"""Scoring on a stream: the row-local stages run unchanged; duplicates need input order and stay out."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from ..config import ScoringConfig
from ..operators import filters
from ..operators.score import score
from ..sources.corpus import with_word_count


def score_stream(verses: DataFrame, config: ScoringConfig | None = None) -> DataFrame:
    """Filter and score a streaming frame of ``ord, surah, ayah, text``."""
    config = replace(config or ScoringConfig(), dedupe_semantic_duplicates=False)
    return score(filters.kept(filters.classify(with_word_count(verses), config)), config)
