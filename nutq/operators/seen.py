"""Keep-first dedup of batches against all batches before, by an index of skeletons on disk.

The index has a folder of first rows and one of Bloom filters for each batch,
dealt into buckets by the skeleton's hash.  A batch asks the filters which of
its skeletons may be known, and only those are joined to the rows of the index.
Nothing that was written is written again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ScoringConfig
from ..sources.shared import checkpointed
from . import filters

#: Bits and hashes of a filter for each of its skeletons: about one in a hundred unknown ones is let through.
BITS, HASHES = 10, 6
BUCKETS = 256
_ROWS = "key string, ord long, surah long, ayah long, bucket int, batch long"
_FILTERS = "bucket int, size long, bits binary, batch long"


def _places(one: np.ndarray, two: np.ndarray, size: int) -> np.ndarray:
    """The bits of each skeleton, from its two hashes."""
    with np.errstate(over="ignore"):
        steps = np.arange(HASHES, dtype=np.uint64)[:, None]
        return (one.view(np.uint64) + steps * (two.view(np.uint64) | np.uint64(1))) % np.uint64(size)


def _filter(frame: pd.DataFrame) -> pd.DataFrame:
    size = max(64, BITS * len(frame))
    bits = np.zeros(size, bool)
    bits[_places(frame["one"].to_numpy(), frame["two"].to_numpy(), size).ravel()] = True
    return pd.DataFrame({"bucket": [frame["bucket"].iloc[0]], "size": [size], "bits": [np.packbits(bits).tobytes()]})


def _may_be_known(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    one, two = asked["one"].to_numpy(np.int64), asked["two"].to_numpy(np.int64)
    found = np.zeros(len(asked), bool)
    for size, bits in zip(known["size"], known["bits"], strict=True):
        at = _places(one, two, int(size))
        raw = np.frombuffer(bits, np.uint8)
        found |= (raw[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1).all(axis=0)
    return asked.loc[found, ["bucket", "key"]]


def _read(spark: SparkSession, path: str, schema: str, batch: int) -> DataFrame:
    """A part of the index without this batch's own share, should it be run again."""
    try:
        return spark.read.schema(schema).parquet(path).where(F.col("batch") != batch)
    except AnalysisException:  # nothing was written yet
        return spark.createDataFrame([], schema)


def classify_batch(verses: DataFrame, index: str, batch: int, config: ScoringConfig | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Reasons as ``filters.classify`` gives, where rows of earlier batches come first; new first rows join the index.

    Batches have numbers of their own, and are judged in the order in which
    they come; one that is run again takes its own place.  ``buckets`` is fixed
    when an index is begun: a bucket's share of a batch's skeletons is one
    task's.  The index is written when this is called, the filters first, so
    that after a lost job it at most asks for more than it needs.
    """
    config = config or ScoringConfig()
    spark, gated = verses.sparkSession, filters.gate(verses, config)
    if not config.dedupe_semantic_duplicates:
        return gated
    passed = filters.keyed(gated)
    bucket = F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int")
    mine = passed.groupBy("_key").agg(F.min(F.struct("ord", "surah", "ayah")).alias("_mine"), F.count("*").alias("_n")).withColumn("bucket", bucket)
    mine = checkpointed(mine.withColumns({"one": F.xxhash64("_key", F.lit(1)), "two": F.xxhash64("_key", F.lit(2))}))
    asked = mine.select("bucket", F.col("_key").alias("key"), "one", "two")
    known = _read(spark, f"{index}/filters", _FILTERS, batch).select("bucket", "size", "bits")
    maybe = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInPandas(_may_be_known, "bucket int, key string")
    rows = _read(spark, f"{index}/rows", _ROWS, batch).join(maybe, ["bucket", "key"])
    # A skeleton is in the index once, but for batches that ran at the same time.
    before = rows.groupBy("key").agg(F.min(F.struct("batch", F.struct("ord", "surah", "ayah").alias("row"))).alias("b")).select(F.col("key").alias("_key"), F.col("b.row").alias("_known"))
    judged = checkpointed(mine.join(before, "_key", "left"))
    new = judged.where("_known IS NULL")
    write = lambda df, name: df.write.mode("overwrite").parquet(f"{index}/{name}/batch={batch}")
    write(new.select("bucket", "one", "two").groupBy("bucket").applyInPandas(_filter, "bucket int, size long, bits binary"), "filters")
    write(new.select(F.col("_key").alias("key"), "_mine.*", "bucket").withColumns({c: F.col(c).cast("long") for c in ("ord", "surah", "ayah")}), "rows")
    # Rows of earlier batches come before all of this one, whatever their places.
    known_first = F.struct(F.lit(-1).cast("long").alias("ord"), F.col("_known.surah").alias("surah"), F.col("_known.ayah").alias("ayah"))
    own_first = F.struct(*[F.col(f"_mine.{c}").cast("long").alias(c) for c in ("ord", "surah", "ayah")])
    first = judged.where("_known IS NOT NULL OR _n > 1").select("_key", F.when(F.col("_known").isNotNull(), known_first).otherwise(own_first).alias("_first"))
    return filters.named_after(gated, passed, first, verses.columns)
