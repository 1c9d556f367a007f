"""Sharding by sampled splitters, in DataFrame functions only.

A record's key holds the hash of its text above a hash of its id, so equal
texts are neighbours.  Keys are sampled with a chance in proportion to the
record's size; quantiles of the sample become splitters, which cut the key
space into ranges of near equal bytes.  Each range is measured exactly, so an
overfull one (a text with very many copies) shows: it is subdivided among its
records' ids, while any other text stays in one shard with all its copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Bits of the key that come from the record's id.
ID_BITS = 24
#: Splitters are looked up on two levels of at most FANOUT each.
FANOUT = 64
#: Expected size of the sample, whatever the input.
SAMPLE = 60_000


def _below(splitters: Column, key: Column) -> Column:
    return F.size(F.filter(splitters, lambda s: s <= key))


def _longs(values: list[int]) -> Column:
    return F.expr("array(" + ", ".join(f"{v}L" if v >= 0 else f"(-{-v}L)" for v in values) + ")") if values else F.expr("array()").cast("array<bigint>")


def splitters(records: DataFrame, total: int) -> list[int]:
    """Ascending splitters from the size-weighted sample; at most FANOUT ** 2 - 1.

    The sample is a function of the records alone, so reruns draw the same one.
    A key met twice among the quantiles marks a hot text: that text keeps its
    inner splitters, any other splitter moves to the start of its text.
    """
    chance = F.col("size") * F.lit(SAMPLE / total)
    drawn = (F.col("pick") % 1_000_003 + 1_000_003) % 1_000_003 / 1_000_003 < chance
    ranked = records.where(drawn).select("key").withColumn("at", F.row_number().over(W.orderBy("key")))
    # The sample is bounded by SAMPLE on average, so one task may rank it.
    n_sample = F.count("*").over(W.partitionBy())
    cut = ranked.withColumn("n", n_sample).where(F.floor(F.col("at") * FANOUT**2 / F.col("n")) > F.floor((F.col("at") - 1) * FANOUT**2 / F.col("n")))
    keys = [r.key for r in cut.select("key").collect()]
    low = (1 << ID_BITS) - 1
    text_of = [k & ~low for k in keys]
    hot = {a for a, b in zip(text_of, text_of[1:], strict=False) if a == b}
    return sorted({k if t in hot else t for k, t in zip(keys, text_of, strict=True)})


def shard(df: DataFrame, shards: int = 40, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Give each record its shard under the law ``bytes``: sizes near equal.

    Returns ``doc_id``, ``size`` (UTF-8 bytes of the text, none if null, plus
    16), ``text_crc32``, ``law``, ``shard``, ``slot`` (gapless in its shard) and
    ``grown_shard`` (null: only the law ``key`` has one).  A null text has the
    checksum of an empty one; a null id is an id like any other; repeated rows
    each get a slot; other columns are not read; an empty table gives no rows.
    """
    payload = F.coalesce(F.col(text), F.lit("")).cast("binary")
    mark = F.xxhash64(F.col(key), F.length(payload), F.col(text))
    high = F.shiftleft(F.shiftright(F.xxhash64(F.col(text)), ID_BITS), ID_BITS)
    records = df.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(payload) + 16).cast("long").alias("size"),
        F.crc32(payload).alias("text_crc32"),
        high.bitwiseOR(mark.bitwiseAND(F.lit((1 << ID_BITS) - 1))).alias("key"),
        F.xxhash64(mark, F.lit(7)).alias("pick"),
    )
    total = records.agg(F.sum("size")).first()[0]
    if not total:
        return _result(records.withColumns({"shard": F.lit(0), "slot": F.lit(0)}))
    marks = splitters(records, total)
    coarse = marks[FANOUT - 1 :: FANOUT]
    fine = [marks[i * FANOUT : (i + 1) * FANOUT - 1] for i in range(len(coarse) + 1)]
    group = _below(_longs(coarse), F.col("key")) if coarse else F.lit(0)
    inner = F.element_at(F.array(*map(_longs, fine)), F.col("group") + 1)
    ranged = records.withColumn("group", group).withColumn("range", F.col("group") * FANOUT + _below(inner, F.col("key"))).drop("group", "pick")
    # A row for each range, at most FANOUT ** 2.
    measured = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    ahead = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = measured.select("range", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("rows_before"))
    placed = ranged.join(F.broadcast(offsets), "range")
    in_range = W.partitionBy("range").orderBy("key", "doc_id", "text_crc32", "size")
    text_of = F.shiftright("key", ID_BITS)
    piece = W.partitionBy("range", "text")
    placed = (
        placed.withColumn("rank", F.col("rows_before") + F.row_number().over(in_range))
        .withColumn("end", F.col("bytes_before") + F.sum("size").over(in_range.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("text", text_of)
        .withColumn("middle", (F.min(F.col("end") - F.col("size")).over(piece) + F.max("end").over(piece)) / 2)
        .withColumn("shard", F.least(F.floor(F.col("middle") * shards / total), F.lit(shards - 1)).cast("int"))
    )
    begins = placed.groupBy("shard").agg((F.min("rank")).alias("begin"))
    return _result(placed.join(F.broadcast(begins), "shard").withColumn("slot", F.col("rank") - F.col("begin")))


def _result(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
