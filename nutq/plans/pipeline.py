"""The scoring plan: filter, score, rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import ScoringConfig
from ..operators import filters
from ..operators.score import score
from ..sources.shared import checkpointed, written


def score_verses(verses: DataFrame, config: ScoringConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """(scored, dropped), both lazy; both keep ``ord``."""
    config = config or ScoringConfig()
    return score(filters.kept_rows(verses, config), config), filters.dropped(filters.classify(verses, config))


def ranked(scored: DataFrame, by: str = "raw", top: int | None = None) -> DataFrame:
    """Sorted by raw score or density, the other one next, then input order; ``top`` rows of it."""
    first, second = ("raw_score", "density_score") if by == "raw" else ("density_score", "raw_score")
    out = scored.orderBy(F.desc(first), F.desc(second), F.asc("ord"))
    if top is not None and top < 0:
        raise ValueError("top must not be negative")
    return out if top is None else out.limit(top)


def with_ranks(scored: DataFrame, by: str = "raw") -> DataFrame:
    """Add ``rank``, the place of every row in the ranking, from 1 and without gaps.

    Rows are sorted in range partitions, once, in the shared folder; a row's rank
    is its place in its partition and the sizes of those before, so no task
    sees more than its range.  They are written before, because ranges are found
    by reading all rows once more, which would score them again.
    """
    placed = checkpointed(ranked(written(scored), by).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("_n"))
    # One row for each partition of the sort.
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn("rank", rank).drop("_part", "_at", "_n", "_before")


def summary(classified: DataFrame) -> DataFrame:
    """One row: total, kept and dropped."""
    return classified.agg(F.count("*").alias("total"), F.count_if(F.col("reason").isNull()).alias("kept"), F.count_if(F.col("reason").isNotNull()).alias("dropped"))
