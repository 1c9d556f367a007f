"""Texts are read, judged and scored no more often than need be."""

from nutq import queries as Q
from nutq.config import ScoringConfig
from nutq.operators import filters
from nutq.operators.score import score, score_many
from nutq.plans.pipeline import with_ranks
from nutq.sources.corpus import with_word_count

TEXTS = ["طَتَ بَ نَ", "قَالَ رَبِّ ٱغْفِرْ", "x", "طَتَ بَ نَ", "طتب نتب بتن"]


def counted(spark):
    """Verses, and how many of them were read so far."""
    read = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    rows = spark.createDataFrame([(i, 1, i, t) for i, t in enumerate(TEXTS)], "ord long, surah int, ayah int, text string")
    return with_word_count(rows.mapInPandas(count, rows.schema)), read


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rules_look_at_one_byte_a_character(spark):
    assert all(p and p.isascii() for gap in ("", " +") for p in ScoringConfig().pair_patterns(gap).values())
    verses, _ = counted(spark)
    assert "regexp_extract_all(_skeleton" not in plan(score(verses).select("raw_score", "density_score"))


def test_hard_letters_are_not_extracted_one_by_one(spark, sf_dir):
    assert "array_distinct" not in plan(Q.QUERIES["zero_bonus"](spark, sf_dir))
    verses = with_word_count(spark.createDataFrame([(1, 1, 1, "ضَظَ ضَ ءَ"), (2, 1, 2, "بَ"), (3, 1, 3, None)], "ord long, surah int, ayah int, text string"))
    assert [r[0] for r in score(verses).orderBy("ord").select("distinct_hard_letters").collect()] == ["ء,ض,ظ", "", None]


def test_texts_are_judged_once(spark):
    verses, read = counted(spark)
    rows = filters.classify(verses, None, ["ord", "surah", "ayah", "text"]).orderBy("ord").collect()
    assert [r.reason for r in rows] == [None, None, "word_count", "duplicate_of_1:0", "not_fully_diacritized"]
    assert [r.text for r in rows] == TEXTS and read.value == len(TEXTS)


def test_no_filter_counts_in_texts(spark, sf_dir):
    verses = Q.verse_view(spark, sf_dir)
    for df in (filters.classify(verses), filters.kept_rows(verses)):
        conditions = [line for line in plan(df.where("reason IS NOT NULL") if "reason" in df.columns else df).splitlines() if "Filter" in line]
        assert conditions and not any("translate" in line or "regexp" in line for line in conditions)


def test_dropped_rows_are_judged_once_for_their_order(spark):
    verses, read = counted(spark)
    drops = filters.dropped(filters.classify(verses, None, ["ord", "surah", "ayah"]))
    assert [r.ord for r in filters.in_stage_order(drops).collect()] == [2, 4, 3]
    assert read.value == len(TEXTS)


def test_ranked_rows_are_scored_once(spark):
    verses, read = counted(spark)
    rows = with_ranks(score(verses)).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5] and read.value == len(TEXTS)


def test_only_first_rows_are_scored_for_many_configurations(spark):
    verses, _ = counted(spark)
    above, below = plan(score_many(verses, {"one": ScoringConfig(), "two": Q.CUSTOM})).split("Aggregate", 1)
    pairs = ScoringConfig().pair_patterns()["same_group"]
    assert pairs in above and pairs not in below
