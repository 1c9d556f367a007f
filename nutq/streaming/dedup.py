"""Keep-first dedup on a stream whose rows may come in any order.

State holds the first row of each skeleton that has come so far.  Rows are
sent on as changes: a row that comes is kept or a duplicate, and where an
earlier one comes late, the row that was kept is taken back and comes again as
a duplicate.  Changes settle to the result of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ScoringConfig
from ..functions import text as T
from ..operators import filters
from ..sources.corpus import with_word_count

_ROW = ["ord", "surah", "ayah", "text"]
#: ``change`` is 1 or -1; a duplicate's ``reason`` is named when changes settle.
CHANGES = "ord long, surah long, ayah long, text string, skeleton string, reason string, change int"
_STATE = "ord long, surah long, ayah long, text string"


def _mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whether a row is the first of its skeleton among those that a task sees at once; others need no state."""
    for frame in frames:
        best = frame.sort_values("ord", kind="stable").drop_duplicates("skeleton").index
        yield frame.assign(candidate=frame.index.isin(best))


def _change(key, frames, state) -> Iterator[pd.DataFrame]:
    """Candidates of one skeleton against the first row so far."""
    (skeleton,), out = key, []
    kept = tuple(state.get) if state.exists else None
    for frame in frames:
        for row in frame.sort_values("ord", kind="stable")[_ROW].itertuples(index=False, name=None):
            if kept is None or row[0] < kept[0]:
                if kept is not None:
                    out += [(*kept, skeleton, None, -1), (*kept, skeleton, "duplicate", 1)]
                kept = row
                out.append((*row, skeleton, None, 1))
            else:
                out.append((*row, skeleton, "duplicate", 1))
    if kept is not None:
        state.update(tuple(x.item() if hasattr(x, "item") else x for x in kept))
    yield pd.DataFrame(out, columns=[*_ROW, "skeleton", "reason", "change"])


def dedup_stream(verses: DataFrame, config: ScoringConfig | None = None) -> DataFrame:
    """The changes that a streaming frame of ``ord, surah, ayah, text`` makes to the table of kept and dropped rows.

    Only the first row of each skeleton in an Arrow batch goes to the state, so
    that a skeleton of a third of all rows is no hot key.  State grows with the
    skeletons.  The output mode is append.
    """
    config = config or ScoringConfig()
    rows = with_word_count(verses.select(*[F.col(c).cast("string" if c == "text" else "long") for c in _ROW]))
    gated = filters.gate(rows, config).select(*_ROW, T.spaced_skeleton(F.col("text")).alias("skeleton"), "reason")
    plus = lambda df: df.withColumn("change", F.lit(1))
    failed = plus(gated if not config.dedupe_semantic_duplicates else gated.where("reason IS NOT NULL"))
    if not config.dedupe_semantic_duplicates:
        return failed
    marked = gated.where("reason IS NULL").select(*_ROW, "skeleton").mapInPandas(_mark, _STATE + ", skeleton string, candidate boolean")
    others = plus(marked.where("NOT candidate").select(*_ROW, "skeleton", F.lit("duplicate").alias("reason")))
    changed = marked.where("candidate").groupBy("skeleton").applyInPandasWithState(_change, CHANGES, _STATE, "append", "NoTimeout")
    return failed.unionByName(others).unionByName(changed)


def settled(changes: DataFrame) -> DataFrame:
    """The table that changes have made: ord, surah, ayah, text, reason, as ``filters.classify`` gives it."""
    left = changes.groupBy(*_ROW, "skeleton", "reason").agg(F.sum("change").alias("n")).where("n > 0").select(*_ROW, "skeleton", "reason", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("_copy")).drop("_copy")
    first = left.where("reason IS NULL").select(F.col("skeleton").alias("_key"), F.struct("ord", "surah", "ayah").alias("_first"))
    again = left.where("reason = 'duplicate'").withColumnRenamed("skeleton", "_key")
    rest = left.where("reason IS NULL OR reason <> 'duplicate'").select(*_ROW, "reason")
    return filters.named_after(rest.where("reason IS NOT NULL"), again, first, _ROW).unionByName(rest.where("reason IS NULL"))
