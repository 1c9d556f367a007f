"""Stages 2 to 5 as column expressions over strings of codes."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ScoringConfig
from ..functions import charclasses as C
from ..functions import text as T

#: The columns of a scored row, in order.
SCORED = (
    "surah ayah text word_count letter_count base_score hard_letter_count distinct_hard_letters adjacency_bonus hard_adjacent_count same_group_count "
    "emphatic_pair_count tajweed_bonus shadda_hard_count madd_guttural_count idgham_count raw_score density_score density_per_letter"
).split()


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) if pattern else F.lit(0)


def _taken(text: Column, pattern: str) -> Column:
    """How often a pattern of one character is met: what the text loses with it.  For frequent ones; no match is made a value."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, "")) if pattern else F.lit(0)


def weight_classes(skeleton: Column, config: ScoringConfig) -> Column:
    """The skeleton's letters that weigh something or are hard, as the codes of their weights: one pass over all letters, few over these."""
    weights = config.weights
    codes = _weight_codes(config)
    left = [c for c in weights if weights[c] not in codes]
    return F.translate(skeleton, C.coded("".join(c for c in weights if weights[c] in codes) + "".join(left)) + " ", "".join(codes[weights[c]] for c in weights if weights[c] in codes))


def _weight_codes(config: ScoringConfig) -> dict[float, str]:
    return dict(zip(sorted(w for w in set(config.weights.values()) if w or w >= config.hard_threshold), C.CODES, strict=False))


def _weighing(classes: Column, config: ScoringConfig) -> dict[float, Column]:
    """How many letters have each weight."""
    return {weight: F.length(classes) - F.length(T.without(classes, code)) for weight, code in _weight_codes(config).items()}


def base_score(classes: Column, config: ScoringConfig) -> Column:
    """Sum of the weights over all letters."""
    total = F.lit(0)
    for weight, n in _weighing(classes, config).items():
        total = total + F.lit(weight) * n if weight else total
    return total


def hard_letter_count(classes: Column, config: ScoringConfig) -> Column:
    total = F.lit(0)
    for weight, n in _weighing(classes, config).items():
        total = total + n if weight >= config.hard_threshold else total
    return total


def distinct_hard_letters(skeleton: Column, config: ScoringConfig) -> Column:
    found = [F.when(F.contains(skeleton, F.lit(C.coded(c))), c) for c in sorted(config.hard_letters)]
    return F.when(skeleton.isNotNull(), F.concat_ws(",", *found))


def adjacency_counts(skeleton: Column, config: ScoringConfig) -> dict[str, Column]:
    """How many neighbouring pairs each rule fires on; a rule without bonus counts nothing, yet keeps its pairs."""
    bonus = {"emphatic": config.bonus_emphatic_pair, "same_group": config.bonus_same_group, "hard_adjacent": config.bonus_hard_adjacent}
    out = {}
    for rule in bonus:
        found = F.lit(0)
        for gap in ["", " +"][: 1 + config.adjacency_across_words]:
            if bonus[rule]:
                found = found + _taken(skeleton, config.pair_patterns(gap)[rule])
        out[rule] = found
    return out


def tajweed_counts(encoded: Column, config: ScoringConfig) -> dict[str, Column]:
    hard, letter, mark, long = C.coded(config.hard_letters), C.CODES, C.CODED_MARKS, C.CODE_LONG
    # Of a letter's marks only one that lengthens is left, once.
    lengthened = F.regexp_replace(T.without(encoded, C.CODE_TANWEEN + C.CODE_SHADDA + C.CODE_SUKUN), f"{long}{long}+", long)
    return {
        "shadda_hard": _taken(encoded, hard and f"[{hard}](?=[{mark}]*{C.CODE_SHADDA})"),
        "madd_guttural": _count(lengthened, hard and f"{long}(?:(?<=[{letter}]{long})(?=[{hard}])|(?<=[{hard}]{long}?[{letter}]{long}))"),
        "idgham": _count(encoded, f"(?:[{letter}][{mark}]*{C.CODE_TANWEEN}[{mark}]*(?:[{C.coded('اي')}][{mark}]*)?|{C.coded('ن')}[{mark}]*{C.CODE_SUKUN}[{mark}]*) (?=[{mark}]*[{C.coded(C.NASAL_FOLLOWERS)}])"),
    }


def density(score: Column, size: Column) -> Column:
    return F.coalesce(F.bround(F.try_divide(score.cast("double"), size.cast("double")), 6), F.lit(0.0))


def encoded_columns(text: Column) -> tuple[Column, Column]:
    """The two strings that all rules are counted on: letters with their marks, and letters alone."""
    encoded = T.encoded(text)
    return encoded, _letters(encoded)


def _letters(encoded: Column) -> Column:
    return T.without(encoded, C.CODED_MARKS)


def _counts(encoded: Column, skeleton: Column, config: ScoringConfig) -> dict[str, Column]:
    """What is counted on the strings; ``_same_group`` leaves out emphatic pairs."""
    pairs, classes = adjacency_counts(skeleton, config), weight_classes(skeleton, config)
    marks = tajweed_counts(encoded, config) if config.enable_tajweed else dict.fromkeys(("shadda_hard", "madd_guttural", "idgham"), F.lit(0))
    return {
        "letter_count": F.length(T.without(skeleton, " ")),
        "base_score": base_score(classes, config),
        "hard_letter_count": hard_letter_count(classes, config),
        "distinct_hard_letters": distinct_hard_letters(skeleton, config),
        "hard_adjacent_count": pairs["hard_adjacent"],
        "emphatic_pair_count": pairs["emphatic"],
        "_same_group": pairs["same_group"],
        "shadda_hard_count": marks["shadda_hard"],
        "madd_guttural_count": marks["madd_guttural"],
        "idgham_count": marks["idgham"],
    }


def _bonuses(of: dict[str, Column], config: ScoringConfig) -> dict[str, Column]:
    emphatic, same, near = of["emphatic_pair_count"], of["_same_group"], of["hard_adjacent_count"]
    return {
        "same_group_count": same + emphatic,
        "adjacency_bonus": emphatic * config.bonus_emphatic_pair + same * config.bonus_same_group + near * config.bonus_hard_adjacent,
        "tajweed_bonus": of["shadda_hard_count"] * config.bonus_shadda_hard + of["madd_guttural_count"] * config.bonus_madd_guttural + of["idgham_count"] * config.bonus_idgham,
    }


def _densities(raw: Column, letters: Column, words: Column, config: ScoringConfig) -> dict[str, Column]:
    return {"density_score": density(raw, letters if config.density_basis == "letter" else words), "density_per_letter": density(raw, letters)}


def score_columns(encoded: Column, skeleton: Column, words: Column, config: ScoringConfig) -> dict[str, Column]:
    """Every score as one expression."""
    of = _counts(encoded, skeleton, config)
    of |= _bonuses(of, config)
    of["raw_score"] = of["base_score"] + of["adjacency_bonus"] + of["tajweed_bonus"]
    of |= _densities(of["raw_score"], of["letter_count"], words, config)
    return {name: of[name] for name in SCORED if name in of}


def _encode(verses: DataFrame) -> DataFrame:
    return verses.withColumn("_encoded", T.encoded(F.col("text"))).withColumn("_skeleton", _letters(F.col("_encoded")))


def _score_encoded(df: DataFrame, config: ScoringConfig) -> DataFrame:
    """Add the scores step by step, so that each is computed once."""
    counts = _counts(F.col("_encoded"), F.col("_skeleton"), config)
    df = df.withColumns(counts).withColumns(_bonuses({name: F.col(name) for name in counts}, config))
    df = df.withColumn("raw_score", F.col("base_score") + F.col("adjacency_bonus") + F.col("tajweed_bonus"))
    return df.withColumns(_densities(F.col("raw_score"), F.col("letter_count"), F.col("word_count"), config))


def score(verses: DataFrame, config: ScoringConfig | None = None) -> DataFrame:
    """Add every score to verses that have ``text`` and ``word_count``; row-local, other columns stay."""
    df = _score_encoded(_encode(verses), config or ScoringConfig())
    rest = [c for c in verses.columns if c not in SCORED]
    return df.select(*rest, *SCORED)


def score_many(verses: DataFrame, configs: dict[str, ScoringConfig]) -> DataFrame:
    """The kept and scored rows of several configurations in one pass: a ``config`` column, then those of ``score``.

    The text is read and judged by its ratio once; a row becomes one row for
    each configuration whose filters it passes, and first rows of a skeleton
    are found for all configurations in one shuffle.  Only those are scored.
    ``verses`` has ``ord``.
    """
    sized = {name: F.col("word_count").between(c.min_word_count, c.max_word_count) for name, c in configs.items()}
    some = reduce(Column.__or__, sized.values())
    df = verses.withColumns({"_ratio": F.when(some, T.diacritization_ratio(F.col("text"))), "_key": F.when(some, T.coded_skeleton(F.col("text")))})
    passes = {name: sized[name] & (F.col("_ratio") >= c.diacritization_min_ratio) if c.require_full_diacritization else sized[name] for name, c in configs.items()}
    rows = df.select("*", F.explode(F.array_compact(F.array(*[F.when(ok, F.lit(name)) for name, ok in passes.items()]))).alias("config"))
    every = [name for name, c in configs.items() if not c.dedupe_semantic_duplicates]
    unique = F.when(F.col("config").isin(every), F.concat(F.lit("\0"), F.col("ord").cast("string"))).otherwise(F.col("_key"))
    whole = F.struct("ord", *[c for c in verses.columns if c != "ord"])
    # A number in front of the skeleton makes the sort that combines rows one of numbers.
    first = rows.select("config", unique.alias("_unique"), whole.alias("_row")).groupBy("config", F.xxhash64("_unique"), "_unique").agg(F.min("_row").alias("_row"))
    df = _encode(first.select("config", "_row.*"))

    def of_config(made: Callable[[ScoringConfig], dict[str, Column]]) -> Column:
        """What each row's own configuration makes; weights and bonuses may be whole in one and not in another."""
        cast = lambda n, c: c if n == "_same_group" or n in ("letter_count", "distinct_hard_letters") or n.endswith("_count") else c.cast("double")
        return F.coalesce(*[F.when(F.col("config") == name, F.struct(*[cast(n, c).alias(n) for n, c in made(config).items()])) for name, config in configs.items()])

    # Step by step, so that each is computed once.
    df = df.withColumn("_counts", of_config(lambda c: _counts(F.col("_encoded"), F.col("_skeleton"), c))).select("*", "_counts.*")
    df = df.withColumn("_bonuses", of_config(lambda c: _bonuses({n: F.col(n) for n in df.columns}, c))).select("*", "_bonuses.*")
    df = df.withColumn("raw_score", F.col("base_score") + F.col("adjacency_bonus") + F.col("tajweed_bonus"))
    df = df.withColumn("_densities", of_config(lambda c: _densities(F.col("raw_score"), F.col("letter_count"), F.col("word_count"), c))).select("*", "_densities.*")
    rest = [c for c in verses.columns if c not in SCORED]
    return df.select("config", *rest, *SCORED)
