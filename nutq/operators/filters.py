"""Stage 1: hard filters, and the reason for every dropped row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ScoringConfig
from ..functions import text as T
from ..sources.shared import written


#: Rows of one skeleton are dealt to so many tasks where they are named after their first.
SALTS = 32


def gate(verses: DataFrame, config: ScoringConfig) -> DataFrame:
    """Add ``reason``: the first row-local filter that failed, or null.

    It comes out of an array of one, so that conditions on it are not pushed
    below it, where texts would be counted again for each of their places.
    """
    reason = F.when(~F.col("word_count").between(config.min_word_count, config.max_word_count), "word_count")
    if config.require_full_diacritization:
        reason = reason.when(~(T.diacritization_ratio(F.col("text")) >= config.diacritization_min_ratio), "not_fully_diacritized")
    return verses.select("*", F.explode(F.array(reason)).alias("reason"))


def classify(verses: DataFrame, config: ScoringConfig | None = None, columns: list[str] | None = None) -> DataFrame:
    """Add ``reason``: null for rows that stay, else the first filter that failed.

    ``verses`` has ``ord`` (its place in the input), ``surah``, ``ayah``,
    ``text`` and ``word_count``.  Of rows with one skeleton the first in input
    order stays.  First rows are found by an aggregation, which combines before
    the shuffle; rows are named after them by skeleton and salt, so a skeleton
    that a third of all rows share is no hot task.  Rows that failed before
    take no part in either.

    That reads the texts three times, lazily.  With ``columns``, which hold
    ``ord``, ``surah`` and ``ayah``, rows have only these and ``reason``; texts
    are read once, and what they came to is written to the shared folder.
    """
    config = config or ScoringConfig()
    df = gate(verses, config)
    if not config.dedupe_semantic_duplicates:
        return df if columns is None else df.select(*columns, "reason")
    if columns is None:
        passed = keyed(df, T.coded_skeleton)
    else:
        df = written(df.select(*columns, "reason", F.when(F.col("reason").isNull(), T.coded_skeleton(F.col("text"))).alias("_key")))
        passed = df.where("reason IS NULL")
    first = passed.groupBy("_key").agg(F.count("*").alias("_n"), F.min(F.struct("ord", "surah", "ayah")).alias("_first")).where("_n > 1").drop("_n")
    return named_after(df.drop("_key"), passed, first, columns or verses.columns)


def keyed(gated: DataFrame, key: Callable[[Column], Column] = T.spaced_skeleton) -> DataFrame:
    """The rows that passed, with their skeleton as ``_key``."""
    return gated.where("reason IS NULL").withColumn("_key", key(F.col("text")))


def named_after(gated: DataFrame, passed: DataFrame, first: DataFrame, columns: list[str]) -> DataFrame:
    """All rows with their reasons; a passed one that isn't the first row of ``first`` (``_key, _first``) is named after it."""
    first = first.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = F.concat(F.lit("duplicate_of_"), F.col("_first.surah").cast("string"), F.lit(":"), F.col("_first.ayah").cast("string"))
    salted = passed.withColumn("_salt", F.pmod(F.xxhash64("ord"), F.lit(SALTS)).cast("int"))
    judged = salted.join(first, ["_key", "_salt"], "left").withColumn("reason", F.when(F.col("_first.ord") < F.col("ord"), named)).select(*columns, "reason")
    return gated.where("reason IS NOT NULL").unionByName(judged)


def kept_rows(verses: DataFrame, config: ScoringConfig | None = None) -> DataFrame:
    """The rows that stay, in one pass: the first whole row of each skeleton, combined before the only shuffle."""
    config = config or ScoringConfig()
    passed = kept(gate(verses, config))
    if not config.dedupe_semantic_duplicates:
        return passed
    row = F.struct("ord", *[c for c in verses.columns if c != "ord"])
    keyed = passed.select(row.alias("_row"), T.coded_skeleton(F.col("text")).alias("_key"))
    # Rows with texts can only be combined in sorted order: a number in front of the skeleton makes that a sort of numbers.
    return keyed.groupBy(F.xxhash64("_key"), "_key").agg(F.min("_row").alias("_row")).select("_row.*").select(*verses.columns)


def kept(classified: DataFrame) -> DataFrame:
    return classified.where("reason IS NULL").drop("reason")


def dropped(classified: DataFrame) -> DataFrame:
    """Rows that do not stay, with their text if they have it."""
    return classified.where("reason IS NOT NULL").select(*[c for c in ("ord", "surah", "ayah", "text", "reason") if c in classified.columns])


def stage(reason: Column) -> Column:
    """The number of the filter that gave a reason: filters judge one after another what those before left."""
    return F.when(reason == "word_count", 1).when(reason == "not_fully_diacritized", 2).otherwise(3)


def in_stage_order(drops: DataFrame) -> DataFrame:
    """Dropped rows in the order in which three passes over the input drop them.

    They are written to the shared folder before, because a sort reads its rows
    once more to find ranges, which would judge them again.
    """
    return written(drops).orderBy(stage(F.col("reason")), "ord")


def drop_reasons(classified: DataFrame) -> DataFrame:
    """How many rows each reason dropped; duplicates are one reason."""
    folded = F.when(F.col("reason").startswith("duplicate"), "duplicate").otherwise(F.col("reason"))
    return classified.where("reason IS NOT NULL").groupBy(folded.alias("reason")).agg(F.count("*").alias("n"))
