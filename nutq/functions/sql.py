"""The column functions and scores as SQL functions, generated from the same compiled rules."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..config import ScoringConfig
from ..operators.score import encoded_columns, score_columns
from . import text as T

PREFIX = "nutq_"
_TEXT = {"t": "string"}
_LETTER = {"ch": "string"}
_PLAIN: dict[str, tuple[dict[str, str], Callable[..., Column]]] = {
    "is_mark": (_LETTER, T.is_mark),
    "is_base_letter": (_LETTER, T.is_base_letter),
    "normalize_letter": (_LETTER, T.normalize_letter),
    "word_count": (_TEXT, T.word_count),
    "words": (_TEXT, T.words),
    "strip_marks": (_TEXT, T.strip_marks),
    "base_letters": (_TEXT, T.base_letters),
    "base_skeleton": (_TEXT, T.base_skeleton),
    "word_skeletons": (_TEXT, T.word_skeletons),
    "spaced_skeleton": (_TEXT, T.spaced_skeleton),
    "letter_clusters": (_TEXT, T.letter_clusters),
    "marked": (_TEXT, T.marked),
    "markable": (_TEXT, T.markable),
    "diacritization_ratio": (_TEXT, T.diacritization_ratio),
    "is_fully_diacritized": ({"t": "string", "least": "double"}, lambda t, least: T.diacritization_ratio(t) >= least),
}


def _sql(column: Column) -> str:
    """A column as SQL text; operators, which Spark prints as calls, become calls of quoted names."""
    tokens = re.compile(r"('(?:\\.|[^'\\])*')|(?<![\w`])([-+*/%=<>!]+|and|or|not)(?=\()", re.S)
    return tokens.sub(lambda m: m[1] or f"`{m[2]}`", column._jc.node().sql())


def definitions(spark: SparkSession, config: ScoringConfig | None = None) -> dict[str, str]:
    """The statement that creates each function, by name."""
    config = config or ScoringConfig()
    made = {name: (args, f(*map(F.col, args))) for name, (args, f) in _PLAIN.items()}
    text = F.col("t")
    for name, column in score_columns(*encoded_columns(text), T.word_count(text), config).items():
        made[name] = (_TEXT, column)
    out = {}
    for name, (args, column) in made.items():
        kind = spark.createDataFrame([], ", ".join(f"{a} {k}" for a, k in args.items())).select(column).schema[0].dataType.simpleString()
        given = ", ".join(f"{a} {k.upper()}" for a, k in args.items())
        out[PREFIX + name] = f"CREATE OR REPLACE TEMPORARY FUNCTION {PREFIX}{name}({given}) RETURNS {kind} RETURN {_sql(column)}"
    return out


def register(spark: SparkSession, config: ScoringConfig | None = None) -> list[str]:
    """Create every function in this session, for the rules of one configuration; their names."""
    made = definitions(spark, config)
    for statement in made.values():
        spark.sql(statement)
    return list(made)


def scored_sql(view: str, config: ScoringConfig | None = None) -> str:
    """SQL text over the functions: the scored rows of a view of ``ord, surah, ayah, text``."""
    c = config or ScoringConfig()
    scores = ["letter_count", *[n for n in score_names() if n != "letter_count"]]
    gate = f"{PREFIX}word_count(text) BETWEEN {c.min_word_count} AND {c.max_word_count}"
    if c.require_full_diacritization:
        gate += f" AND {PREFIX}is_fully_diacritized(text, DOUBLE({c.diacritization_min_ratio!r}))"
    gated = f"SELECT ord, surah, ayah, text, {PREFIX}spaced_skeleton(text) AS skeleton FROM {view} WHERE {gate}"
    first = f"SELECT min_by(struct(ord, surah, ayah, text), ord) AS v FROM ({gated}) GROUP BY skeleton" if c.dedupe_semantic_duplicates else f"SELECT struct(ord, surah, ayah, text) AS v FROM ({gated})"
    columns = ", ".join(f"{PREFIX}{n}(text) AS {n}" for n in scores)
    return f"SELECT ord, surah, ayah, text, {PREFIX}word_count(text) AS word_count, {columns} FROM (SELECT v.* FROM ({first}))"


def score_names() -> list[str]:
    from ..operators.score import SCORED

    return [n for n in SCORED if n not in ("surah", "ayah", "text", "word_count")]
