"""Batches and streams end in what one run over all rows gives."""

import os
import random

import pytest
from pyspark.sql import functions as F

from nutq.config import ScoringConfig
from nutq.operators import filters, seen
from nutq.sources import corpus
from nutq.streaming.dedup import dedup_stream, settled

CONFIG = ScoringConfig(min_word_count=1, diacritization_min_ratio=0.2)
SCHEMA = "ord long, surah long, ayah long, text string"


def rows(n=240, seed=6):
    rng = random.Random(seed)
    words = ["طَتَ", "بَ", "نَ", "طت", "قَالَ", "x"]
    return [(i, 1 + i // 50, i % 50, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 1, 2, 3])))) for i in range(n)]


def frame(spark, some):
    return corpus.with_word_count(spark.createDataFrame(some, SCHEMA))


def told(df):
    return sorted((r.ord, r.surah, r.ayah, r.text, r.reason or "") for r in df.select("ord", "surah", "ayah", "text", "reason").collect())


def files(path):
    return {(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names}


def test_batches_equal_one_run(spark, tmp_path):
    every, index, got = rows(), str(tmp_path / "index"), []
    for batch in range(4):
        before = files(index)
        out = told(seen.classify_batch(frame(spark, every[60 * batch : 60 * batch + 60]), index, batch, CONFIG, buckets=5))
        got += out
        assert before.items() <= files(index).items()  # nothing is written again
        if batch == 2:  # run again, as after a lost job
            assert told(seen.classify_batch(frame(spark, every[120:180]), index, batch, CONFIG, buckets=5)) == out
    want = told(filters.classify(frame(spark, every), CONFIG))
    assert sorted(got) == want and len({r[4] for r in want}) > 10
    assert spark.read.parquet(f"{index}/rows").count() == len([r for r in want if not r[4]])


def test_filters_lose_nothing_and_let_little_through(spark, tmp_path):
    index = str(tmp_path / "index")
    letters = "بتثجحخدذرزسشصضطظعغفقكلمنهوي"
    text = lambda lo, hi: [(i, 1, i, "".join(letters[i // 27**k % 27] + "َ" for k in range(4))) for i in range(lo, hi)]
    seen.classify_batch(frame(spark, text(0, 3000)), index, 0, CONFIG, buckets=3).count()
    asked = frame(spark, text(2000, 6000)).select(F.col("text"))
    out = seen.classify_batch(frame(spark, text(2000, 6000)), index, 1, CONFIG, buckets=3)
    assert out.where("reason LIKE 'dup%'").count() == 1000 and asked.count() == 4000
    from nutq.functions import text as T

    keys = asked.select(T.spaced_skeleton(F.col("text")).alias("key")).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(3)).cast("int"))
    keys = keys.withColumns({"one": F.xxhash64("key", F.lit(1)), "two": F.xxhash64("key", F.lit(2))})
    known = spark.read.parquet(f"{index}/filters/batch=0")
    maybe = keys.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInPandas(seen._may_be_known, "bucket int, key string").count()
    assert 1000 <= maybe < 1150


@pytest.mark.parametrize("seed", [1, 2])
def test_streams_in_any_order_settle(spark, tmp_path, seed):
    every = rows(120)
    want = told(filters.classify(frame(spark, every), CONFIG))
    mixed = list(every)
    random.Random(seed).shuffle(mixed)
    for i in range(4):
        spark.createDataFrame(mixed[30 * i : 30 * i + 30], SCHEMA).repartition(2).write.parquet(str(tmp_path / f"in/b={i}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in/*"))
    query = dedup_stream(stream, CONFIG).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    assert query.awaitTermination(150)
    changes = spark.read.parquet(str(tmp_path / "out"))
    assert told(settled(changes)) == want
    assert changes.where("change < 0").count() > 0
