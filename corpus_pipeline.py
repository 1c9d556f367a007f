"""A corpus pipeline of training-data operators: each stage works on all that the one before kept.

A stage begins by deleting the intermediate tables of the stage before, whose
result is a table by then, and no others.  Nulls, empty and very long texts, ties, repeated
rows and empty tables are treated as the docstring of the stage's operator
says; columns other than those of ``documents`` are not read.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutq.llm import bpe, jaccard, mixing, quality, substrings
from nutq.llm.kernel import load, scope, sweep, write_table
from nutq.llm.queries import RANKS

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Folders of the tables that the stage before has left.
_left: list[str] = []


def _stage(work):
    """A stage whose intermediate tables the next one deletes."""

    @functools.wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        sweep(spark, _left, docs)
        with scope() as made:
            out = work(spark, docs, sf_dir)
        _left[:] = made
        return out

    return run


@_stage
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = quality.classify(spark, docs, load(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.where("predicted = 1").select(*COLUMNS)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id."""
    return jaccard.near_duplicates(spark, docs, keep=COLUMNS).where("stays").select(*COLUMNS)


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document holds go; every document stays, if only as an empty text."""
    cut = substrings.dedup(spark, docs, keep=tuple(c for c in COLUMNS if c != "text"), with_text=True)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


@_stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text becomes what the mix takes of it; documents it takes nothing of go."""
    mixed = mixing.mix(spark, docs, keep=COLUMNS, with_text=True).where("taken > 0")
    return mixed.withColumn("n_chars", F.when(F.col("taken") == F.col("size"), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text that is left."""
    return bpe.encode_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", encode),
]

#: The first stage is a learnt classifier, which SQL cannot express; tests hold the others against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = write_table(spark, stage(spark, docs, sf_dir))
    return docs
