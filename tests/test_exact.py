"""Files equal Python's writers, ranks a stable sort, dropped rows three passes."""

import csv
import io
import json
import random

from pyspark.sql import functions as F

from nutq.config import ScoringConfig
from nutq.operators import filters
from nutq.plans.pipeline import ranked, with_ranks
from nutq.sources import corpus, sinks
from nutq.sources.exact import write_file


def test_bytes_equal_the_standard_library(spark, tmp_path):
    rng = random.Random(4)
    odd = ['"', ",", "\n", "\r\n", "}", "},\n", "é", "漢", "\\", "a", " ", "\x85", "'", "\t"]
    rows = [(i, rng.choice([None, rng.uniform(-1, 1) * 10 ** rng.randint(-12, 20), 0.0, 1e-5, 1 / 3]), rng.choice([None, True, False]), "".join(rng.choice(odd) for _ in range(rng.randint(0, 6)))) for i in range(300)]
    names = ["id", "x", "flag", "text"]
    df = spark.createDataFrame(rows, "id long, x double, flag boolean, text string").repartition(5).orderBy("id")
    for name, frame, want in (("full", df, rows), ("none", df.where("id < 0"), []), ("one", df.where("id = 7"), rows[7:8])):
        out = io.StringIO(newline="")
        csv.writer(out).writerows([names, *want])
        assert open(write_file(frame, str(tmp_path / f"{name}.csv"), "csv"), "rb").read() == out.getvalue().encode()
        text = json.dumps([dict(zip(names, r, strict=True)) for r in want], ensure_ascii=False, indent=2)
        assert open(write_file(frame, str(tmp_path / f"{name}.json"), "json"), "rb").read() == text.encode()
    write_file(df.where("id = 7"), str(tmp_path / "full.csv"), "csv")  # takes the place of the one before
    assert (tmp_path / "full.csv").read_bytes() == (tmp_path / "one.csv").read_bytes()


def test_outputs_as_single_files(spark, tmp_path):
    df = corpus.with_word_count(spark.createDataFrame([(i, 1, i, t) for i, t in enumerate(["طَتَ بَ نَ", "x", "طَتَ بَ نَ"])], "ord long, surah int, ayah int, text string"))
    classified = filters.classify(df)
    from nutq.operators.score import SCORED, score

    sinks.write_outputs(ranked(score(filters.kept(classified))), filters.in_stage_order(filters.dropped(classified)), ScoringConfig(), str(tmp_path), single_files=True)
    rows = json.loads((tmp_path / "ayah_scores.json").read_text(encoding="utf-8"))
    assert [list(r) for r in rows] == [SCORED]
    assert (tmp_path / "dropped_ayahs.csv").read_bytes().decode() == "surah,ayah,text,reason\r\n1,1,x,word_count\r\n1,2,طَتَ بَ نَ,duplicate_of_1:0\r\n"


def test_ranks_equal_a_stable_sort(spark):
    rows = [(i, i * 7 % 5, float(i * 3 % 4)) for i in range(500)]
    df = spark.createDataFrame(rows, "ord long, raw_score int, density_score double").repartition(6)
    for by, key in (("raw", lambda r: (-r[1], -r[2])), ("density", lambda r: (-r[2], -r[1]))):
        got = with_ranks(df, by)
        assert [(r.rank, r.ord) for r in got.orderBy("rank").collect()] == [(i + 1, r[0]) for i, r in enumerate(sorted(rows, key=key))]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_dropped_rows_come_stage_by_stage(spark):
    good, bare = "طَتَ بَ نَ", "طت بت نن"
    texts = [good, bare, "x", good, "y", bare, good]
    df = corpus.with_word_count(spark.createDataFrame([(i, 1, i, t) for i, t in enumerate(texts)], "ord long, surah int, ayah int, text string"))
    rows = filters.in_stage_order(filters.dropped(filters.classify(df))).collect()
    assert [r.ayah for r in rows] == [2, 4, 1, 5, 3, 6]
    assert df.where(F.col("ord") < 0).count() == 0
