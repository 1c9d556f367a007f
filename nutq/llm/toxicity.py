"""Toxicity by a weighted lexicon.

Texts are folded first: case, look-alike letters of other scripts, full-width
forms, and digits or signs that stand for letters inside a word.  The lexicon
holds whole words and word beginnings whose share in labelled toxic texts is
surely above that in the other labelled texts; its weights are the lower ends
of their log odds.  All terms are matched at once by an Aho-Corasick automaton.
Matches inside an exception phrase (two words that labelled clean texts use)
do not count, and the sum is normalised by length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel

#: Labelled rows that the lexicon is learnt from, about; more are sampled by a hash of the id.
FIT_ROWS = 12_000
#: Lengths of word beginnings that may be terms.
BEGINNINGS = (4, 5, 6, 7, 8)
LEAST_TEXTS = 8
LEAST_WEIGHT = 2.0
#: How sure a term must be, in standard errors of its log odds.
SURE = 2.0
#: Clean texts that must share a phrase around a term before it is an exception.
LEAST_EXCEPTION = 3

# Look-alike letters, and signs that stand for letters.
LOOKALIKES = str.maketrans("аеорсухіјѕԁһӏтмнкгвьαοερτυνικӧıɑɡ", "aeopcyxijsdhltmhkrbbaoeptuvikoiag")
SIGNS = str.maketrans("013457@$!", "oieastasi")
_SIGN = re.compile("[013457@$!]")
_LOOKALIKE = re.compile("[" + "".join(map(chr, LOOKALIKES)) + "！-～]")
#: Signs that show nothing or sit on a letter: they part no word.
_INVISIBLE = re.compile("[\u00ad\u0300-\u036f\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]")
_ODD_BREAK = re.compile("[\u00a0-\u00bf\u2000-\u206f\u3000-\u303f]")
_WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
_ALNUM = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def fold(text: str) -> str:
    """Words in lower case with one space around each."""
    text = text.lower()
    if not text.isascii():
        text = _INVISIBLE.sub("", text)
        if _LOOKALIKE.search(text):
            text = text.translate(_WIDE).lower().translate(LOOKALIKES)
        text = _ODD_BREAK.sub(" ", text)
    if _SIGN.search(text):
        text = " ".join([w if w.isalpha() else _letters(w) for w in text.split()])
    return " " + " ".join(text.encode().translate(_ALNUM).decode().split()) + " "


def _letters(word: str) -> str:
    """Signs become letters where the word has letters too; those after its end stay signs."""
    body = word.rstrip("!?.,;:")
    return body.translate(SIGNS) if any(map(str.isalpha, body)) else body


def _terms(words: set[str]) -> set[str]:
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in BEGINNINGS if len(w) > k}


def _sharpest(terms: dict[str, tuple[int, int, float]]) -> dict[str, float]:
    """Without word beginnings that a longer term replaces: most of the toxic texts, and half the clean ones or fewer."""
    out = {k: w for k, (_, _, w) in terms.items()}
    for term, (t, c, _) in terms.items():
        for k in range(5, len(term)):
            short = terms.get(term[:k])
            if short and 0 < short[1] >= 2 * c and t >= 0.7 * short[0]:
                out.pop(term[:k], None)
    return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, toxic, n: texts of each class that hold a term."""
    for batch in batches:
        for label in (0, 1):
            count: Counter[str] = Counter()
            for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                if y == label:
                    count.update(_terms(set(fold(text).split())))
            yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array([label] * len(count), pa.int32()), pa.array(list(count.values()), pa.int64())], names=["term", "toxic", "n"])


class Matcher:
    """The automaton over a lexicon, with its exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: frozenset[str] = frozenset()):
        import ahocorasick

        self.exceptions, self.automaton = exceptions, ahocorasick.Automaton()
        for term, weight in lexicon.items():
            self.automaton.add_word(term, (len(term), weight))
        if lexicon:
            self.automaton.make_automaton()
        self.empty = not lexicon

    def hits(self, folded: str) -> dict[int, float]:
        """Where a matched word starts, and the largest weight of its matches."""
        found: dict[int, float] = {}
        if not self.empty:
            for end, (size, weight) in self.automaton.iter(folded):
                at = end - size + 2
                found[at] = max(weight, found.get(at, 0.0))
        return found

    @staticmethod
    def phrases(folded: str, at: int) -> tuple[str, str]:
        """The word at a place with the word before it, and with the word after it."""
        stop = folded.index(" ", at)
        before = folded.rfind(" ", 0, at - 1) + 1
        after = folded.find(" ", stop + 1)
        return folded[before:stop], folded[at : after if after >= 0 else len(folded)].strip()

    def value(self, text: str) -> float:
        folded = fold(text)
        total = 0.0
        for at, weight in self.hits(folded).items():
            if not self.exceptions or not self.exceptions.intersection(self.phrases(folded, at)):
                total += weight
        return total / np.log(np.e + folded.count(" ") / 100)


def _around(lexicon: dict[str, float]):
    """phrase, toxic, n: texts of each class that hold a phrase around a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            count: Counter[tuple[str, int]] = Counter()
            for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                folded = fold(text)
                count.update({(p, y) for at in matcher.hits(folded) for p in matcher.phrases(folded, at) if " " in p})
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in count], pa.string()), pa.array([k[1] for k in count], pa.int32()), pa.array(list(count.values()), pa.int64())], names=["phrase", "toxic", "n"])

    return run


def _values(keep: list[str], lexicon: dict[str, float], exceptions: frozenset[str], curve: tuple[float, float] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon, exceptions)
        for batch in batches:
            column = batch.column("text")
            for first, last in kernel.chunks(column):
                x = np.array([matcher.value(t) for t in column.slice(first, last - first).to_pylist()])
                if curve:
                    x = 1 / (1 + np.exp(-np.clip(curve[0] + curve[1] * np.log1p(x), -30, 30)))
                rows = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*map(rows.column, keep), pa.array(x, pa.float64())], names=[*keep, "score"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    z, b = np.column_stack([np.ones_like(x), x]), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * len(x) / 1000 * np.eye(2)
        b = b + np.clip(np.linalg.solve(h, z.T @ (y - p) - ridge * len(x) / 1000 * b), -3, 3)
    return float(b[0]), float(b[1])


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "toxic", keep: tuple[str, ...] = ("doc_id",), modulus: int = 5, held: int = 0) -> DataFrame:
    """Score every whole text: ``keep``, ``held_out``, ``score``, ``predicted``.

    Learns from rows whose crc32 of the id, modulo ``modulus``, is not
    ``held``; of more than FIT_ROWS such labels, about FIT_ROWS are drawn by a
    hash of the id.  Equal texts count once while learning.  A null text counts
    as empty; a null id has no label; null labels are passed over; repeated
    rows are scored each; other columns are not read; an empty table gives no
    rows.  Without labels of both classes to learn from, every score is 0.
    """
    keep = kernel.without_made(keep, "held_out", "score", "predicted")
    held_out = kernel.remainder("doc_id", modulus) == held
    truth = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out).select("doc_id", F.col(label).cast("int").alias("label"))
    n = truth.select("doc_id").distinct().count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 53)) < int((1 << 53) * min(1, FIT_ROWS / max(n, 1)))
    drawn = truth.where(share).distinct()  # about FIT_ROWS ids, however often a label is repeated
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id").dropDuplicates(["text", "label"])
    sample = kernel.materialize(spark, known.select("text", "label"))
    classes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    clean, toxic = classes.get(0, 0), classes.get(1, 0)
    counted = sample.mapInArrow(_count_terms, "term string, toxic int, n long").groupBy("term").agg(F.sum(F.col("n") * F.col("toxic")).alias("t"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    weight = odds - SURE * F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    # Bounded by FIT_ROWS: a term needs LEAST_TEXTS of the toxic texts drawn.
    terms = counted.where(F.col("t") >= LEAST_TEXTS).withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
    lexicon = _sharpest({r.term: (r.t, r.c, r.weight) for r in terms.collect()})
    about = sample.mapInArrow(_around(lexicon), "phrase string, toxic int, n long").groupBy("phrase").agg(F.sum(F.col("n") * F.col("toxic")).alias("t"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("c"))
    exceptions = frozenset(r.phrase for r in about.where((F.col("c") >= LEAST_EXCEPTION) & (F.col("c") * toxic > 4 * F.col("t") * clean)).select("phrase").collect())
    curve = (-30.0, 0.0)
    if toxic and clean:
        fit = sample.mapInArrow(_values(["label"], lexicon, exceptions, None), "label int, score double").toPandas()
        curve = logistic(np.log1p(fit["score"].to_numpy()), fit["label"].to_numpy(float))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (docs.schema[c] for c in keep))
    text = kernel.text_column(docs.withColumn("held_out", held_out), *keep, "held_out")
    scored = text.mapInArrow(_values([*keep, "held_out"], lexicon, exceptions, curve), f"{kept}, held_out boolean, score double")
    if not (toxic and clean):
        scored = scored.withColumn("score", F.lit(0.0))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
