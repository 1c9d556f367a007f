"""Readers: corpus JSON, raw ``chapter|verse|text`` lines, Parquet; and the opening formula."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import charclasses as C
from ..functions import text as T
from .json_array import read_elements
from .lines import numbered_lines

# The script names and the opening formula.
SCRIPTS = {
    "uthmani": "Uthmani text as in the Madina Mushaf (primary source)",
    "uthmani-min": "Uthmani text with a minimal number of diacritics/symbols",
    "simple": "Simple (Imla'ei) text, fully diacritized",
    "simple-plain": "Simple text without ikhfa/idgham demonstration",
    "simple-min": "Simple text with minimal diacritics",
    "simple-clean": "Simple text without any diacritics (skeleton only)",
}
OPENING_FORMULA = "بسم الله الرحمن الرحيم"
#: Chapters whose first verse has no opening formula to strip.
UNSTRIPPED_CHAPTERS = (1, 9)
_VERSE = "struct<surah:string,ayah:string,text:string>"
_LINE = "struct<ord:bigint,surah:string,ayah:string,text:string>"


def with_word_count(verses: DataFrame) -> DataFrame:
    return verses.withColumn("word_count", T.word_count(F.col("text")))


def _checked(rows: DataFrame) -> DataFrame:
    """Verses of ``ord, col`` where ``col`` has surah, ayah and text as strings; one that lacks any is an error."""
    need = lambda name: F.coalesce(F.col(f"col.{name}"), F.raise_error(F.lit(f"verse without {name}")).cast("string"))
    return with_word_count(rows.select("ord", need("surah").cast("int").alias("surah"), need("ayah").cast("int").alias("ayah"), need("text").alias("text")))


def _is_lines(spark: SparkSession, path: str) -> bool:
    """Whether a corpus is lines of verses: its first object, told from the beginning of a file, has its place in it."""
    head = "".join(r.value + "}" for r in spark.read.text(path, lineSep="}").take(64))
    try:
        first, _ = json.JSONDecoder().raw_decode(head.lstrip("\ufeff \t\r\n"))
    except ValueError:
        return False
    return isinstance(first, dict) and "ord" in first and "verses" not in first


def load_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Verses of a corpus JSON: an object with ``verses``, a bare array, or lines of verses with their ``ord``.

    ``ord`` is the place in the array, counted on over several files in the
    order of their names.  Every form is read in byte ranges, so a file of any
    size is read by many tasks.  Ids may be quoted.  Text that isn't JSON, JSON
    of another form, and a missing id or text are errors.
    """
    strict = {"mode": "FAILFAST"}
    if _is_lines(spark, path):
        lines = spark.read.text(path).where("trim(value) != ''").select(F.from_json("value", _LINE, strict).alias("col"))
        return _checked(lines.select("col.ord", "col"))
    return _checked(read_elements(spark, path).select("ord", F.from_json("value", _VERSE, strict).alias("col")))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Verses of lines ``ord, value``; comments, blanks and malformed lines are skipped."""
    part = F.split("value", r"\|", 3)
    good = F.when(F.col("value").startswith("#") | (F.col("value") == ""), False).otherwise((F.size(part) == 3) & part[0].rlike("^[0-9]+$") & part[1].rlike("^[0-9]+$"))
    text = F.regexp_replace(part[2], f"^[{C.SPACES}]+|[{C.SPACES}]+$", "")
    return lines.where(good).select("ord", part[0].cast("int").alias("surah"), part[1].cast("int").alias("ayah"), text.alias("text"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Verses of raw text files, numbered by line, read in byte ranges."""
    return parse_lines(numbered_lines(spark, path))


def strip_opening(verses: DataFrame) -> DataFrame:
    """Take the opening formula off first verses; ``stripped`` says where."""
    found = T.words(F.col("text"))
    skeleton = F.regexp_replace(F.translate(F.concat_ws("", F.slice(found, 1, 4)), C.FOLD_FROM, C.FOLD_TO), f"[^{C.ranges(C.BASE)}]", "")
    hit = (F.col("ayah") == 1) & ~F.col("surah").isin(*UNSTRIPPED_CHAPTERS) & (F.size(found) > 4) & (skeleton == OPENING_FORMULA.replace(" ", ""))
    rest = F.concat_ws(" ", F.slice(found, F.lit(5), F.greatest(F.size(found) - 4, F.lit(0))))
    return verses.withColumn("stripped", hit).withColumn("text", F.when(F.col("stripped"), rest).otherwise(F.col("text")))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Verses of a Parquet table with ``surah``, ``ayah``, ``text`` and, where there is one, ``ord``."""
    df = spark.read.parquet(path)
    if "ord" not in df.columns:
        df = df.withColumn("ord", F.col("surah").cast("long") * (1 << 32) + F.col("ayah"))  # no two pairs of 32-bit numbers share one
    return with_word_count(df.select(F.col("ord").cast("long"), F.col("surah").cast("int"), F.col("ayah").cast("int"), "text"))


def recitation_shortlist(spark: SparkSession, path: str) -> DataFrame:
    """Reader name and bit rate of storage prefixes such as ``.../Name_128kbps/``."""
    lines = spark.read.text(path).where("value != ''")
    part = lambda k: F.regexp_extract("value", r"([^/]+)_(\d+)kbps/?$", k)
    return lines.select(F.col("value").alias("prefix"), part(1).alias("reciter"), F.expr("try_cast(regexp_extract(value, '([^/]+)_([0-9]+)kbps/?$', 2) AS INT)").alias("kbps"))
