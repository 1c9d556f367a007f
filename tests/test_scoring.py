import random

import pytest
from pyspark.sql import functions as F

from nutq.config import ScoringConfig
from nutq.functions import charclasses as C
from nutq.functions import text as T
from nutq.operators.score import score
from nutq.sources.corpus import with_word_count

from . import by_letter

QUIET = ScoringConfig(enable_tajweed=False)


def verses(spark, texts):
    return with_word_count(spark.createDataFrame([(i, 1, i, t) for i, t in enumerate(texts)], "ord long, surah int, ayah int, text string"))


def one(spark, text, config=None):
    return score(verses(spark, [text]), config).first()


@pytest.mark.parametrize("text,skeleton", [("أَنَّ", "ان"), ("ٱللَّهِ", "الله"), ("رَحْمَةً", "رحمت"), ("يُؤْمِنُونَ", "يومنون"), ("شَىْءٍ", "شيء")])
def test_skeleton(spark, text, skeleton):
    assert spark.range(1).select(T.base_skeleton(F.lit(text))).first()[0] == skeleton


def test_marks_and_ratio(spark):
    row = spark.range(1).select(T.strip_marks(F.lit("قَالَ")), T.diacritization_ratio(F.lit("بسم الله")), T.diacritization_ratio(F.lit("بِسْمِ ٱللَّهِ")), T.is_fully_diacritized(F.lit("بِسْمِ ٱللَّهِ"), 0.75)).first()
    assert tuple(row) == ("قال", 0.0, 0.75, True)
    row = spark.range(1).select(T.is_mark(F.lit("َ")), T.is_base_letter(F.lit("ب")), T.normalize_letter(F.lit("أ")), T.normalize_letter(F.lit("x")), T.words(F.lit(" a b ")), T.word_skeletons(F.lit("")), T.base_letters(F.lit("أب"))).first()
    assert tuple(row) == (True, True, "ا", None, ["a", "b"], [], ["ا", "ب"])


@pytest.mark.parametrize("text,config,bonus,column", [("طَتَ", QUIET, 4, "emphatic_pair_count"), ("بَمَ", QUIET, 3, "same_group_count"), ("خَطَ", QUIET, 2, "hard_adjacent_count"), ("طَ تَ", ScoringConfig(enable_tajweed=False, adjacency_across_words=True), 4, "emphatic_pair_count")])
def test_adjacency(spark, text, config, bonus, column):
    row = one(spark, text, config)
    assert (row.adjacency_bonus, row[column]) == (bonus, 1)


def test_no_adjacency(spark):
    assert one(spark, "بَتَ", QUIET).adjacency_bonus == 0
    assert one(spark, "طَ تَ", QUIET).adjacency_bonus == 0


@pytest.mark.parametrize("text,config,want", [("طَتَ", QUIET, (2, 3, 4, 0, 7, 7.0, 3.5)), ("خَطَ", QUIET, (2, 6, 2, 0, 8, 8.0, 4.0)), ("ضَضْ بَتَ", QUIET, (4, 8, 2, 0, 10, 5.0, 2.5)), ("ضَّالِّينَ", None, (5, 4, 0, 1, 5, 5.0, 1.0)), ("مِنْ مَاءٍ", None, (5, 2, 0, 1, 3, 1.5, 0.6))])
def test_whole_rows(spark, text, config, want):
    row = one(spark, text, config)
    assert (row.letter_count, row.base_score, row.adjacency_bonus, row.tajweed_bonus, row.raw_score, row.density_score, row.density_per_letter) == want


def test_precomposed_madda_has_no_mark(spark):
    assert one(spark, "ضآل").madd_guttural_count == 0
    assert one(spark, "ضآل").madd_guttural_count == 1


def test_empty_text(spark):
    row = one(spark, "")
    assert (row.word_count, row.letter_count, row.raw_score, row.density_score, row.distinct_hard_letters) == (0, 0, 0, 0.0, "")


def random_text(rng):
    alphabet = C.BASE * 2 + C.FOLD_FROM + "ًࣰٍَُِّْٰٓۖ" * 3 + C.TATWEEL + "xz+|1" + "   \t "
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))


CONFIGS = [
    ScoringConfig(),
    ScoringConfig(adjacency_across_words=True, density_basis="letter"),
    ScoringConfig.from_dict({"letter_weights": {"ض": 5, "ن": 1, "?": 9}, "hard_threshold": 1}),
    ScoringConfig.from_dict({"hard_threshold": 0, "bonus_same_group": 0, "articulation_groups": {"": ["ب", "ت"], "b": ["ب", "ت", "ن"]}}),
    ScoringConfig.from_dict({"bonus_emphatic_pair": 0, "emphatic_pairs": [["ل", "ل"], ["ا", "ن"]], "articulation_groups": {}}),
    ScoringConfig.from_dict({"letter_weights": {}, "emphatic_pairs": []}),
]


@pytest.mark.parametrize("number", range(len(CONFIGS)))
def test_lowering_equals_letter_by_letter(spark, number):
    rng, config = random.Random(number), CONFIGS[number]
    texts = [random_text(rng) for _ in range(600)]
    rows = score(verses(spark, texts), config).orderBy("ord").collect()
    for text, row in zip(texts, rows, strict=True):
        want = by_letter.score(text, len(text.split()), config)
        assert row.word_count == len(text.split())
        assert {k: row[k] for k in want} == want, repr(text)


def test_ratio_and_key_equal_letter_by_letter(spark):
    rng = random.Random(99)
    texts = [random_text(rng) for _ in range(1500)]
    df = verses(spark, texts).select("ord", T.diacritization_ratio(F.col("text")).alias("r"), T.spaced_skeleton(F.col("text")).alias("k")).orderBy("ord")
    for text, row in zip(texts, df.collect(), strict=True):
        assert row.r == pytest.approx(by_letter.ratio(text)), repr(text)
        assert row.k == by_letter.key(text), repr(text)


def test_rows_are_scored_without_shuffle_or_python(spark):
    plan = score(verses(spark, ["طَتَ"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
