"""Column functions on raw text: words, skeletons, clusters, diacritization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import charclasses as C


def is_mark(ch: Column) -> Column:
    return ch.rlike(f"^[{C.MARKS}]$")


def is_base_letter(ch: Column) -> Column:
    return ch.rlike(f"^[{C.ranges(C.BASE)}]$")


def normalize_letter(ch: Column) -> Column:
    """The base letter of one character; null for anything else."""
    folded = F.translate(ch, C.FOLD_FROM, C.FOLD_TO)
    return F.when(is_base_letter(folded), folded)


def joined(text: Column) -> Column:
    """The words with single spaces between them."""
    return F.trim(F.regexp_replace(text, f"{C.SPACE}+", " "))


def words(text: Column) -> Column:
    one = joined(text)
    return F.when(one == "", F.array().cast("array<string>")).otherwise(F.split(one, " "))


def without(text: Column, letters: str) -> Column:
    """The text without some characters; one after another, which is faster than a pattern that is met often."""
    for c in letters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def coded(text: Column) -> Column:
    """The words as codes of their letters and marks, with single spaces between them; what is neither stays as another sign, so that no word is lost."""
    return F.trim(F.regexp_replace(F.translate(text, *C.TO_CODES), "  +", " "))


def encoded(text: Column) -> Column:
    """Codes of the letters, each followed by those of its marks; a word may begin with marks of no letter."""
    return F.regexp_replace(without(coded(text), C.OTHER), C.UNKNOWN, "")


def coded_skeleton(text: Column) -> Column:
    """As ``spaced_skeleton``, in codes."""
    return without(encoded(text), C.CODED_MARKS)


def word_count(text: Column) -> Column:
    ended = F.ltrim(F.concat(coded(text), F.lit(" ")))  # every word ends with a space
    return F.length(ended) - F.length(without(ended, " "))


def strip_marks(text: Column) -> Column:
    return F.regexp_replace(text, f"[{C.TATWEEL}{C.MARKS}]", "")


def base_skeleton(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, C.FOLD_FROM, C.FOLD_TO), f"[^{C.ranges(C.BASE)}]", "")


def base_letters(text: Column) -> Column:
    return F.regexp_extract_all(base_skeleton(text), F.lit(f"[{C.ranges(C.BASE)}]"), 0)


def spaced_skeleton(text: Column) -> Column:
    """Skeletons of the words, joined by a space; a word without letters stays as an empty one."""
    return F.translate(coded_skeleton(text), C.CODES, C.BASE)


def word_skeletons(text: Column) -> Column:
    return F.when(joined(text) == "", F.array().cast("array<string>")).otherwise(F.split(spaced_skeleton(text), " "))


def letter_clusters(text: Column) -> Column:
    """Letters with the marks that follow them, as strings; the first character is the letter."""
    only = F.regexp_replace(F.translate(joined(text), C.FOLD_FROM, C.FOLD_TO), f"[^{C.ranges(C.BASE)}{C.MARKS} ]", "")
    return F.regexp_extract_all(only, F.lit(f"[{C.ranges(C.BASE)}][{C.MARKS}]*"), 0)


def _inner(text: Column) -> Column:
    """Letters but the last one of each word, as kinds; one that needs a vowel sign and has a mark is an ``a``."""
    first, second = C.TO_KINDS
    kinds = F.regexp_replace(F.translate(text, first + C.TATWEEL, second), C.UNKNOWN, C.OTHER)
    signed = F.replace(kinds, F.lit(C.NEEDS + C.MARK), F.lit("a"))
    ended = F.concat(without(signed, C.MARK + C.OTHER), F.lit(" "))
    for last in ("a", C.NEEDS, C.CARRIES):
        ended = F.replace(ended, F.lit(last + " "), F.lit(C.OTHER))
    return ended


def markable(text: Column) -> Column:
    """Letters that should carry a mark: no vowel carrier, and another letter follows in the word."""
    return F.length(without(_inner(text), f"{C.CARRIES}{C.OTHER} "))


def marked(text: Column) -> Column:
    return F.length(without(_inner(text), f"{C.NEEDS}{C.CARRIES}{C.OTHER} "))


def diacritization_ratio(text: Column) -> Column:
    """Share of markable letters that carry a mark; 1 where there is none."""
    return F.coalesce(F.try_divide(marked(text).cast("double"), markable(text).cast("double")), F.lit(1.0))


def is_fully_diacritized(text: Column, min_ratio: float = 1.0) -> Column:
    return diacritization_ratio(text) >= min_ratio
