"""Codepoint classes as regular-expression fragments.

Fixed values: the letters, marks and folds of the scoring rules.
"""

import re

TATWEEL = "\u0640"
#: Base letters after normalisation.
BASE = "ابتثجحخدذرزسشصضطظعغفقكلمنهويء"
#: Letter variants and what they are folded to, position by position.
FOLD_FROM = "\u0622\u0623\u0625\u0671\u0672\u0673\u0624\u0626\u0649\u0629"
FOLD_TO = "\u0627\u0627\u0627\u0627\u0627\u0627\u0648\u064a\u064a\u062a"
#: Raw letters that need no vowel sign.
VOWEL_CARRIERS = "\u0627\u0622\u0671\u0672\u0673\u0649\u0648\u064a"
#: Combining marks, the inside of a character class.
MARKS = "\u064b-\u065f\u0670\u06d6-\u06ed\u08f0-\u08ff"
TANWEEN = "\u064b-\u064d"
SUKUN, SHADDA, MADDAH, DAGGER_ALEF = "\u0652", "\u0651", "\u0653", "\u0670"
#: Unicode white space, the inside of a character class.
SPACES = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters that a nasal ending merges into or is hidden before: all but alef.
NASAL_FOLLOWERS = BASE.replace("ا", "")


def ranges(letters: str) -> str:
    """Letters as the inside of a character class, neighbours as ranges: its parts are tried one after another."""
    runs: list[list[int]] = []
    for code in sorted(set(map(ord, letters))):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in runs)


LETTERS = BASE + FOLD_FROM
VOWELLED = "".join(c for c in LETTERS if c not in VOWEL_CARRIERS)
#: One white space; decides about the script's own block first.
SPACE = f"[[^\u0600-\u06ff]&&[{SPACES}]]"


def _members(inside: str) -> str:
    """All characters of the inside of a character class."""
    parts = re.findall(r"(.)-(.)|(.)", inside, re.S)
    return "".join("".join(map(chr, range(ord(a), ord(b) + 1))) if a else one for a, b, one in parts)


# Rules are counted on texts of one byte a character.  Regular expressions look such characters up in a table if they are
# listed one by one, so classes of codes have no ranges.
#: The letter that stands for each base letter, position by position.
CODES = "ABCDEFGHIJKLMNOPQRSTUVWXYZabc"
#: What stands for a tanween, a shadda, a sukun, a mark that lengthens; and for anything else that is no space, but for what is beyond ASCII and unknown.
CODE_TANWEEN, CODE_SHADDA, CODE_SUKUN, CODE_LONG, OTHER = "1234x"
CODED_MARKS = CODE_TANWEEN + CODE_SHADDA + CODE_SUKUN + CODE_LONG
UNKNOWN = r"[\x80-\x{10ffff}]+"
_BLANK = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACES}]", c))


def coded(letters: str) -> str:
    """The codes of base letters."""
    return letters.translate(str.maketrans(BASE, CODES))


def _map(parts: dict[str, str]) -> tuple[str, str]:
    """Both sides of a translation: the characters of each key become its value, or those at their places; all other ASCII is ``OTHER``."""
    first, second = "".join(parts), "".join(b if len(a) == len(b) else b * len(a) for a, b in parts.items())
    other = "".join(c for c in map(chr, range(128)) if c not in first)
    return first + other, second + OTHER * len(other)


#: From texts to codes.
TO_CODES = _map({BASE: CODES, FOLD_FROM: coded(FOLD_TO), _members(TANWEEN): CODE_TANWEEN, SHADDA: CODE_SHADDA, SUKUN: CODE_SUKUN, MADDAH + DAGGER_ALEF: CODE_LONG, _BLANK: " ", "\u064e\u064f\u0650" + TATWEEL: OTHER})
#: For the ratio: letters that need a vowel sign, other letters, marks.
NEEDS, CARRIES, MARK = "vcm"
TO_KINDS = _map({VOWELLED: NEEDS, "".join(c for c in LETTERS if c in VOWEL_CARRIERS): CARRIES, _members(MARKS): MARK, _BLANK: " "})
