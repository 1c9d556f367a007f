"""SQL functions and many configurations give what the library gives."""

from dataclasses import replace

from pyspark.sql import functions as F

from nutq.config import ScoringConfig
from nutq.functions import sql
from nutq.functions import text as T
from nutq.operators import filters
from nutq.operators.score import SCORED, score, score_many
from nutq.queries import CUSTOM, verse_view


def test_functions_equal_columns(spark, sf_dir):
    names = sql.register(spark)
    verses = verse_view(spark, sf_dir, True).select("text")
    verses.createOrReplaceTempView("some_texts")
    plain = {n: f for n, (args, f) in sql._PLAIN.items() if list(args) == ["t"]}
    got = spark.sql(f"SELECT {', '.join(f'nutq_{n}(text) AS {n}' for n in plain)}, nutq_is_fully_diacritized(text, 0.5D) AS full, nutq_normalize_letter(left(text, 1)) AS letter, nutq_is_mark(left(text, 1)) AS mark FROM some_texts")
    first = F.substring("text", 1, 1)
    want = verses.select(*[f(F.col("text")).alias(n) for n, f in plain.items()], T.is_fully_diacritized(F.col("text"), 0.5).alias("full"), T.normalize_letter(first).alias("letter"), T.is_mark(first).alias("mark"))
    assert got.dtypes == want.dtypes and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert len(names) == len(plain) + 4 + len(sql.score_names())


def test_sql_text_gives_the_scored_table(spark, sf_dir):
    verses = verse_view(spark, sf_dir)
    verses.createOrReplaceTempView("verses_to_score")
    for config in (ScoringConfig(), CUSTOM):
        sql.register(spark, config)
        got = spark.sql(sql.scored_sql("verses_to_score", config))
        want = score(filters.kept_rows(verses, config), config).select(*got.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_ten_configurations_in_one_pass(spark, sf_dir):
    base = ScoringConfig(min_word_count=1, diacritization_min_ratio=0.4)
    configs = {"default": ScoringConfig(), "custom": CUSTOM, "none": replace(base, min_word_count=900, max_word_count=901)}
    configs |= {f"n{i}": replace(base, max_word_count=4 + i, enable_tajweed=i % 2 == 0, dedupe_semantic_duplicates=i != 3, require_full_diacritization=i != 4, density_basis="letter" if i > 4 else "word", bonus_idgham=i / 2) for i in range(7)}
    verses = verse_view(spark, sf_dir)
    many = score_many(verses, configs)
    got = {name: [] for name in configs}
    for r in many.collect():
        got[r.config].append(tuple(r[c] for c in ["ord", *SCORED]))
    for name, config in configs.items():
        want = score(filters.kept_rows(verses, config), config).select("ord", *SCORED).collect()
        assert sorted(got[name]) == sorted(map(tuple, want)), name
    assert len(got["default"]) > 5 and not got["none"]
    assert many._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("FileScan") == 1
