"""Registered queries over the test tables, and their DuckDB twins.

The tables hold no Arabic, so queries read a *verse view* of ``documents``:
lines of the lower-cased text with the Latin letters mapped to Arabic letters
and marks.  The twins share no lowering with the library: they are a plan over
one row per character.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import ScoringConfig
from .functions import charclasses as C
from .functions import sql
from .functions import text as T
from .operators import filters, seen
from .operators.score import SCORED, score, score_many
from .plans.pipeline import ranked, summary, with_ranks
from .sources import corpus
from .sources.exact import write_file
from .sources.shared import shared_root
from .streaming.dedup import CHANGES, dedup_stream, settled

LATIN = "abcdefghijklmnopqrstuvwxyz.,!?"
ARABIC = "\u064e\u0628\u062b\u062f\u0650\u0636\u063a\u0647\u0652\u062c\u0642\u0644\u0645\u0646\u064f\u0635\u062d\u0631\u0633\u0637\u0651\u0638\u0648\u062e\u064a\u0632\u064b\u0653\u0670\u064d"
#: A second map, whose capitals become letter variants and tatweel.
LATIN_2 = LATIN + "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ARABIC_2 = ARABIC + (C.FOLD_FROM + C.TATWEEL) * 2 + "ءافك"

TOP = 20
CUSTOM = ScoringConfig.from_dict({"letter_weights": {"ض": 5, "ظ": 5, "ن": 1}, "hard_threshold": 1, "emphatic_pairs": [["ض", "ن"]], "articulation_groups": {"a": ["د", "ر"], "b": ["ر", "ن"]}, "min_word_count": 4, "max_word_count": 8, "adjacency_across_words": True})
NO_BONUS = ScoringConfig.from_dict({"bonus_same_group": 0, "bonus_madd_guttural": 0, "bonus_emphatic_pair": 7})
#: Configurations that are scored in one pass.
MANY = {"default": ScoringConfig(), "custom": CUSTOM, "loose": replace(NO_BONUS, min_word_count=1, max_word_count=30, diacritization_min_ratio=0.3), "all": replace(ScoringConfig(), dedupe_semantic_duplicates=False, enable_tajweed=False, density_basis="letter")}
PLACE = ["ord", "surah", "ayah"]
MANY_COLUMNS = ["word_count", "letter_count", "base_score", "adjacency_bonus", "tajweed_bonus", "raw_score", "density_score"]
LONG = {"casts": ["word_count", "letter_count", "base_score", "hard_letter_count", "adjacency_bonus", "hard_adjacent_count", "same_group_count", "emphatic_pair_count", "tajweed_bonus", "shadda_hard_count", "madd_guttural_count", "idgham_count", "raw_score", "surah", "ayah", "ord"]}


def _spread(df: DataFrame) -> DataFrame:
    """A small table that is read in fewer pieces than there are cores is dealt out; a large one stays as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def verse_view(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    return _verses(_spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), second)


def _verses(docs: DataFrame, second: bool = False) -> DataFrame:
    line = docs.select("doc_id", F.posexplode(F.split("text" if second else F.lower("text"), "\n")).alias("pos", "line"))
    text = F.translate("line", LATIN_2, ARABIC_2) if second else F.translate("line", LATIN, ARABIC)
    verses = line.select((F.shiftleft(F.col("doc_id"), 32) + F.col("pos")).alias("ord"), F.col("doc_id").alias("surah"), (F.col("pos") + 1).cast("long").alias("ayah"), text.alias("text"))
    return corpus.with_word_count(verses)


def _longs(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in df.columns if c in LONG["casts"]})


def _scores(columns: str, config: ScoringConfig | None = None, kept: bool = False):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        verses = verse_view(spark, sf_dir)
        if kept:
            verses = filters.kept_rows(verses, config)
        return _longs(score(verses, config).select("surah", "ayah", *columns.split()))

    return run


def _texts(second: bool = False, **columns: Callable[[Column], Column]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _longs(verse_view(spark, sf_dir, second).select("surah", "ayah", *[f(F.col("text")).alias(name) for name, f in columns.items()]))

    return run


def _classified(config: ScoringConfig | None, pick: Callable[[DataFrame], DataFrame], *more: str):
    return lambda spark, sf_dir: _longs(pick(filters.classify(verse_view(spark, sf_dir), config, [*PLACE, *more])))


def _top(by: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = score(filters.kept_rows(verse_view(spark, sf_dir)))
        return _longs(ranked(scored, by, TOP).select("surah", "ayah", "text", "raw_score", "density_score"))

    return run


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw corpus lines made of the verse view: every verse as a valid line, and after it lines to skip."""
    surah, ayah = F.col("surah").cast("string"), F.col("ayah").cast("string")
    valid = F.concat_ws("|", surah, ayah, F.concat(F.lit(" "), "text", F.lit("|z ")))
    skipped = [F.concat(F.lit("# "), valid), F.concat_ws("|", F.lit("x"), ayah, "text"), F.concat_ws("|", surah, ayah), F.lit("")]
    return verse_view(spark, sf_dir).select("ord", F.explode(F.array(valid, *skipped)).alias("value"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _longs(corpus.parse_lines(_raw_lines(spark, sf_dir)))


def _opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = verse_view(spark, sf_dir)
    led = v.withColumn("text", F.when(F.col("surah") % 3 < 2, F.concat(F.lit("بِسْمِ ٱللَّهِ ٱلرَّحْمَٰنِ ٱلرَّحِيمِ "), "text")).otherwise(F.col("text"))).withColumn("surah", F.col("surah") % 40)
    return _longs(corpus.strip_opening(led).select("ord", "surah", "ayah", "text", "stripped"))


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/nutq-{uuid.uuid4().hex}-{name}"


def _corpus_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verses through one JSON array that is read in byte ranges."""
    ordered = verse_view(spark, sf_dir).orderBy("ord").select("surah", "ayah", "text")
    return _longs(corpus.load_corpus(spark, write_file(ordered, _new_path(spark, "corpus.json"), "json")))


def _raw_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text files, with lines to skip, read in byte ranges and numbered over all of them."""
    path = _new_path(spark, "raw")
    _raw_lines(spark, sf_dir).withColumn("_place", F.monotonically_increasing_id()).orderBy("ord", "_place").select(F.translate("value", "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029", "")).write.text(path)
    return _longs(corpus.read_lines(spark, path))


def _csv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of one CSV file as it stands on disk."""
    ordered = verse_view(spark, sf_dir).orderBy("ord").select("surah", "ayah", "word_count", F.translate("text", "\r", "").alias("text"))
    path = write_file(ordered, _new_path(spark, "verses.csv"), "csv")
    return spark.read.text(path, lineSep="\r\n").select("value")


def _ranked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(verse_view(spark, sf_dir)).select("ord", "surah", "ayah", "raw_score", "density_score")
    return _longs(with_ranks(scored).select("rank", "surah", "ayah", "raw_score", "density_score"))


def _dropped_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    drops = filters.dropped(filters.classify(verse_view(spark, sf_dir), None, PLACE))
    return _longs(filters.in_stage_order(drops).select(filters.stage(F.col("reason")).cast("long").alias("stage"), "ord", "surah", "ayah", "reason"))


def _letter_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every character of the texts and what it is."""
    ch = verse_view(spark, sf_dir, True).select(F.explode(F.split("text", "")).alias("ch")).groupBy("ch").agg(F.count("*").alias("n")).where("ch <> ''")
    return ch.select("ch", "n", T.is_mark(F.col("ch")).alias("mark"), T.is_base_letter(F.col("ch")).alias("base"), T.normalize_letter(F.col("ch")).alias("letter"))


def _corpus_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _opening(spark, sf_dir).agg(F.count("*").alias("verse_count"), F.count_if("stripped").alias("basmala_stripped"))


def _sql_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored table by SQL text over the library's SQL functions."""
    sql.register(spark)
    verse_view(spark, sf_dir).createOrReplaceTempView("nutq_verses")
    return _longs(spark.sql(sql.scored_sql("nutq_verses")).select("surah", "ayah", *SCORED[2:]))


def _many_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _longs(score_many(verse_view(spark, sf_dir), MANY).select("config", "surah", "ayah", *MANY_COLUMNS))


def _dedup_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches in the order of the documents, each judged against the index of those before."""
    verses, index = verse_view(spark, sf_dir), _new_path(spark, "index")
    step = (verses.agg(F.max("surah")).first()[0] or 0) // 4 + 1
    done = [seen.classify_batch(verses.where(F.floor(F.col("surah") / step) == i), index, i, buckets=16) for i in range(4)]
    return _longs(reduce(DataFrame.unionByName, done).select("surah", "ayah", "reason"))


def _dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept and dropped rows as the changes of a stream leave them."""
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    stream = _verses(spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]").select("doc_id", "text"))
    out = _new_path(spark, "changes")
    dedup_stream(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start().awaitTermination()
    return _longs(settled(spark.read.schema(CHANGES).parquet(out)).select("surah", "ayah", "reason"))


QUERIES = {
    "word_count": _texts(word_count=T.word_count),
    "strip_marks": _texts(plain=T.strip_marks),
    "base_skeleton": _texts(skeleton=T.base_skeleton, word_skeletons=T.spaced_skeleton),
    "normalize_letters": _texts(True, plain=T.strip_marks, skeleton=T.base_skeleton),
    "letter_clusters": _texts(True, clusters=lambda t: F.array_join(T.letter_clusters(t), "/")),
    "diacritization_ratio": _texts(marked=lambda t: T.marked(t).cast("long"), markable=lambda t: T.markable(t).cast("long"), ratio=lambda t: F.bround(T.diacritization_ratio(t), 6), full=lambda t: T.is_fully_diacritized(t, 0.7)),
    "diacritization_variants": _texts(True, marked=lambda t: T.marked(t).cast("long"), markable=lambda t: T.markable(t).cast("long")),
    "hard_filters": _classified(None, lambda df: df.select("surah", "ayah", "reason")),
    "semantic_dedup": lambda spark, sf_dir: _longs(filters.kept_rows(verse_view(spark, sf_dir)).select("surah", "ayah", "text", "word_count")),
    "dropped_report": _classified(None, lambda df: filters.dropped(df).drop("ord"), "text"),
    "drop_reasons": _classified(None, filters.drop_reasons),
    "drop_summary": _classified(None, summary),
    "base_letter_weights": _scores("letter_count base_score"),
    "hard_letters": _scores("hard_letter_count distinct_hard_letters"),
    "adjacency": _scores("adjacency_bonus hard_adjacent_count same_group_count emphatic_pair_count"),
    "adjacency_across_words": _scores("adjacency_bonus hard_adjacent_count same_group_count emphatic_pair_count", ScoringConfig(adjacency_across_words=True)),
    "tajweed": _scores("tajweed_bonus shadda_hard_count madd_guttural_count idgham_count"),
    "no_tajweed": _scores("tajweed_bonus idgham_count raw_score", ScoringConfig(enable_tajweed=False)),
    "density_word": _scores("raw_score density_score"),
    "density_letter": _scores("density_score density_per_letter", ScoringConfig(density_basis="letter")),
    "scored_table": _scores(" ".join(SCORED[2:]), None, kept=True),
    "custom_weights": _scores(" ".join(SCORED[4:]), CUSTOM, kept=True),
    "zero_bonus": _scores(" ".join(SCORED[4:]), NO_BONUS),
    "topk_raw": _top("raw"),
    "topk_density": _top("density"),
    "parse_lines": _parsed,
    "strip_opening": _opening,
    "words": _texts(True, words=lambda t: F.array_join(T.words(t), "/"), letters=lambda t: F.array_join(T.base_letters(t), "/")),
    "letter_classes": _letter_classes,
    "corpus_counts": _corpus_counts,
    "corpus_json": _corpus_json,
    "raw_file": _raw_file,
    "csv_file": _csv_file,
    "ranked_rows": _ranked_rows,
    "dropped_in_order": _dropped_in_order,
    "sql_scored": _sql_scored,
    "many_configs": _many_configs,
    "dedup_batches": _dedup_batches,
    "dedup_stream": _dedup_stream,
}


# --- the twins ----------------------------------------------------------------

_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}]+"


def _view_sql(second: bool = False) -> str:
    line = "text" if second else "lower(text)"
    maps = (LATIN_2, ARABIC_2) if second else (LATIN, ARABIC)
    return f"""
lines AS (SELECT doc_id, string_split({line}, chr(10)) AS l FROM documents),
placed AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM lines),
verses AS (SELECT doc_id * 4294967296 + pos AS ord, doc_id AS surah, pos + 1 AS ayah, translate(line, '{maps[0]}', '{maps[1]}') AS text FROM placed)"""


def _chars_sql(source: str = "verses") -> str:
    """Tokens, characters and both kinds of letter clusters."""
    marks = " OR ".join(f"cp BETWEEN {a} AND {b}" for a, b in ((0x64B, 0x65F), (0x670, 0x670), (0x6D6, 0x6ED), (0x8F0, 0x8FF)))
    return f"""
toks AS (SELECT ord, list_filter(string_split_regex(text, '{_WS}'), lambda x: x <> '') AS t FROM {source}),
tok AS (SELECT ord, unnest(t) AS w, unnest(range(len(t))) AS ti FROM toks),
cs AS (SELECT ord, ti, string_split(w, '') AS c FROM tok WHERE w <> ''),
ch0 AS (SELECT ord, ti, unnest(c) AS ch, unnest(range(len(c))) AS p FROM cs),
ch1 AS (SELECT *, unicode(ch) AS cp, translate(ch, '{C.FOLD_FROM}', '{C.FOLD_TO}') AS norm FROM ch0),
ch AS (SELECT *, ({marks}) AS is_mark, strpos('{C.BASE}', norm) > 0 AS is_letter FROM ch1 WHERE cp <> {ord(C.TATWEEL)}),
cl0 AS (SELECT *, sum(is_letter::int) OVER (PARTITION BY ord, ti ORDER BY p) AS ci, sum((NOT is_mark)::int) OVER (PARTITION BY ord, ti ORDER BY p) AS bi FROM ch),
cl AS (SELECT ord, ti, ci, max(norm) FILTER (is_letter) AS letter, coalesce(string_agg(ch, '' ORDER BY p) FILTER (is_mark), '') AS marks, bool_or(cp = 1617) AS shadda,
  bool_or(cp IN (1619, 1648)) AS long, bool_or(cp BETWEEN 1611 AND 1613) AS tanween, bool_or(cp = 1618) AS sukun FROM cl0 WHERE ci > 0 GROUP BY ord, ti, ci),
raw0 AS (SELECT ord, ti, bi, max(ch) FILTER (is_letter) AS raw, bool_or(is_mark) AS marked FROM cl0 WHERE bi > 0 GROUP BY ord, ti, bi),
raw1 AS (SELECT *, bi = max(bi) OVER (PARTITION BY ord, ti) AS last FROM raw0 WHERE raw IS NOT NULL),
ratio AS (SELECT ord, sum(marked::int) AS marked, count(*) AS markable FROM raw1 WHERE NOT last AND strpos('{C.VOWEL_CARRIERS}', raw) = 0 GROUP BY ord),
sk0 AS (SELECT ord, ti, string_agg(letter, '' ORDER BY ci) AS s FROM cl GROUP BY ord, ti),
sk AS (SELECT tok.ord, count(*) AS word_count, string_agg(coalesce(s, ''), ' ' ORDER BY tok.ti) AS key FROM tok LEFT JOIN sk0 ON tok.ord = sk0.ord AND tok.ti = sk0.ti GROUP BY tok.ord),
base AS (SELECT v.*, coalesce(word_count, 0) AS word_count, coalesce(key, '') AS key, coalesce(marked, 0) AS marked, coalesce(markable, 0) AS markable,
  CASE WHEN coalesce(markable, 0) = 0 THEN 1.0::double ELSE marked::double / markable END AS ratio FROM {source} v LEFT JOIN sk ON v.ord = sk.ord LEFT JOIN ratio r ON v.ord = r.ord)"""


def _classify_sql(c: ScoringConfig) -> str:
    return f"""
gate AS (SELECT *, CASE WHEN word_count NOT BETWEEN {c.min_word_count} AND {c.max_word_count} THEN 'word_count' WHEN ratio < {c.diacritization_min_ratio} THEN 'not_fully_diacritized' END AS gated FROM base),
dup AS (SELECT ord, row_number() OVER k AS rn, first(surah) OVER k AS s0, first(ayah) OVER k AS a0 FROM gate WHERE gated IS NULL WINDOW k AS (PARTITION BY key ORDER BY ord)),
classified AS (SELECT g.*, coalesce(gated, CASE WHEN {str(c.dedupe_semantic_duplicates).lower()} AND rn > 1 THEN 'duplicate_of_' || s0 || ':' || a0 END) AS reason FROM gate g LEFT JOIN dup ON g.ord = dup.ord)"""


def _score_sql(c: ScoringConfig) -> str:
    letters = ", ".join(f"('{x}', {w}, {str(x in c.hard_letters).lower()})" for x, w in c.weights.items())
    names = {"emphatic": ("emphatic", c.bonus_emphatic_pair), "same_group": ("same", c.bonus_same_group), "hard_adjacent": ("hard", c.bonus_hard_adjacent)}
    pairs = ", ".join(
        f"('{pair[0]}', '{pair[1]}', '{names[rule][0]}', {names[rule][1]})" for pair, rule in c.pair_rules.items() if names[rule][1]
    )
    t = int(c.enable_tajweed)
    across = "" if c.adjacency_across_words else "AND x.ti = x.nti"
    basis = "letter_count" if c.density_basis == "letter" else "word_count"
    return f"""
lw(letter, weight, hard) AS (VALUES {letters}),
pr(a, b, rule, bonus) AS (VALUES {pairs}),
seq AS (SELECT cl.*, weight, hard, lead(cl.letter) OVER o AS nl, lead(ti) OVER o AS nti, lag(hard) OVER w AS ph, lead(hard) OVER w AS nh FROM cl JOIN lw ON cl.letter = lw.letter WINDOW o AS (PARTITION BY ord ORDER BY ti, ci), w AS (PARTITION BY ord, ti ORDER BY ci)),
s2 AS (SELECT ord, count(*) AS letter_count, sum(weight) AS base_score, sum(hard::int) AS hard_letter_count, coalesce(string_agg(DISTINCT letter, ',' ORDER BY letter) FILTER (hard), '') AS distinct_hard_letters,
  {t} * sum((hard AND shadda)::int) AS shadda_hard_count, {t} * sum((long AND (coalesce(ph, false) OR coalesce(nh, false)))::int) AS madd_guttural_count FROM seq GROUP BY ord),
s3 AS (SELECT ord, sum(bonus) AS adjacency_bonus, count(*) FILTER (rule = 'hard') AS hard_adjacent_count, count(*) FILTER (rule IN ('same', 'emphatic')) AS same_group_count, count(*) FILTER (rule = 'emphatic') AS emphatic_pair_count
  FROM seq x JOIN pr ON x.letter = pr.a AND x.nl = pr.b {across} GROUP BY ord),
ends AS (SELECT ord, ti, arg_min(letter, ci) AS first_letter, arg_max(letter, ci) AS last_letter, arg_max(tanween, ci) AS lt, arg_max(sukun, ci) AS ls, max(ci) AS n FROM cl GROUP BY ord, ti),
ends2 AS (SELECT e.*, coalesce(b.tanween, false) AS bt FROM ends e LEFT JOIN cl b ON b.ord = e.ord AND b.ti = e.ti AND b.ci = e.n - 1),
s4 AS (SELECT a.ord, {t} * count(*) AS idgham_count FROM ends2 a JOIN ends2 b ON a.ord = b.ord AND b.ti = a.ti + 1 WHERE b.first_letter <> 'ا' AND (a.lt OR (a.last_letter IN ('ا', 'ي') AND a.bt) OR (a.last_letter = 'ن' AND a.ls)) GROUP BY a.ord),
parts AS (SELECT v.*, coalesce(letter_count, 0) AS letter_count, coalesce(base_score, 0) AS base_score, coalesce(hard_letter_count, 0) AS hard_letter_count, coalesce(distinct_hard_letters, '') AS distinct_hard_letters,
  coalesce(adjacency_bonus, 0) AS adjacency_bonus, coalesce(hard_adjacent_count, 0) AS hard_adjacent_count, coalesce(same_group_count, 0) AS same_group_count, coalesce(emphatic_pair_count, 0) AS emphatic_pair_count,
  coalesce(shadda_hard_count, 0) AS shadda_hard_count, coalesce(madd_guttural_count, 0) AS madd_guttural_count, coalesce(idgham_count, 0) AS idgham_count
  FROM base v LEFT JOIN s2 ON v.ord = s2.ord LEFT JOIN s3 ON v.ord = s3.ord LEFT JOIN s4 ON v.ord = s4.ord),
summed AS (SELECT *, shadda_hard_count * {c.bonus_shadda_hard} + madd_guttural_count * {c.bonus_madd_guttural} + idgham_count * {c.bonus_idgham} AS tajweed_bonus FROM parts),
totals AS (SELECT *, base_score + adjacency_bonus + tajweed_bonus AS raw_score FROM summed),
scored AS (SELECT *, CASE WHEN {basis} = 0 THEN 0.0::double ELSE round_even(raw_score::double / {basis}, 6) END AS density_score, CASE WHEN letter_count = 0 THEN 0.0::double ELSE round_even(raw_score::double / letter_count, 6) END AS density_per_letter FROM totals)"""


def _cast(columns: str) -> str:
    return ", ".join(f"CAST({x} AS BIGINT) AS {x}" if x in LONG["casts"] else x for x in columns.split())


def _scored_sql(columns: str, config: ScoringConfig | None = None, kept: bool = False, tail: str = "") -> str:
    c = config or ScoringConfig()
    ctes = [_view_sql(), _chars_sql(), *([_classify_sql(c)] if kept else []), _score_sql(c)]
    where = "JOIN (SELECT ord AS o FROM classified WHERE reason IS NULL) k ON scored.ord = k.o" if kept else ""
    return f"WITH {','.join(ctes)} SELECT {_cast('surah ayah ' + columns)} FROM scored {where} {tail}"


def _text_sql(select: str, second: bool = False) -> str:
    return f"WITH {_view_sql(second)},{_chars_sql()} SELECT CAST(surah AS BIGINT) AS surah, CAST(ayah AS BIGINT) AS ayah, {select} FROM base"


def _class_sql(select: str) -> str:
    return f"WITH {_view_sql()},{_chars_sql()},{_classify_sql(ScoringConfig())} {select}"


_PLAIN = f"regexp_replace(text, '[{C.TATWEEL}\\x{{64b}}-\\x{{65f}}\\x{{670}}\\x{{6d6}}-\\x{{6ed}}\\x{{8f0}}-\\x{{8ff}}]', '', 'g') AS plain"
_ADJ = "adjacency_bonus hard_adjacent_count same_group_count emphatic_pair_count"
_IDS = "CAST(surah AS BIGINT) AS surah, CAST(ayah AS BIGINT) AS ayah"
_LED = "CASE WHEN surah % 3 < 2 THEN 'بِسْمِ ٱللَّهِ ٱلرَّحْمَٰنِ ٱلرَّحِيمِ ' || text ELSE text END"

ORACLE = {
    "word_count": _text_sql("CAST(word_count AS BIGINT) AS word_count"),
    "strip_marks": _text_sql(_PLAIN),
    "base_skeleton": _text_sql("replace(key, ' ', '') AS skeleton, key AS word_skeletons"),
    "normalize_letters": _text_sql(_PLAIN + ", replace(key, ' ', '') AS skeleton", True),
    "letter_clusters": f"WITH {_view_sql(True)},{_chars_sql()}, j AS (SELECT ord, string_agg(letter || marks, '/' ORDER BY ti, ci) AS clusters FROM cl GROUP BY ord) SELECT {_IDS}, coalesce(clusters, '') AS clusters FROM verses LEFT JOIN j ON verses.ord = j.ord",
    "diacritization_ratio": _text_sql('CAST(marked AS BIGINT) AS marked, CAST(markable AS BIGINT) AS markable, round_even(ratio, 6) AS ratio, ratio >= 0.7 AS "full"'),
    "diacritization_variants": _text_sql("CAST(marked AS BIGINT) AS marked, CAST(markable AS BIGINT) AS markable", True),
    "hard_filters": _class_sql(f"SELECT {_IDS}, reason FROM classified"),
    "semantic_dedup": _class_sql(f"SELECT {_IDS}, text, CAST(word_count AS BIGINT) AS word_count FROM classified WHERE reason IS NULL"),
    "dropped_report": _class_sql(f"SELECT {_IDS}, text, reason FROM classified WHERE reason IS NOT NULL"),
    "drop_reasons": _class_sql("SELECT string_split(reason, '_of_')[1] AS reason, count(*) AS n FROM classified WHERE reason IS NOT NULL GROUP BY ALL"),
    "drop_summary": _class_sql("SELECT count(*) AS total, count(*) FILTER (reason IS NULL) AS kept, count(*) FILTER (reason IS NOT NULL) AS dropped FROM classified"),
    "base_letter_weights": _scored_sql("letter_count base_score"),
    "hard_letters": _scored_sql("hard_letter_count distinct_hard_letters"),
    "adjacency": _scored_sql(_ADJ),
    "adjacency_across_words": _scored_sql(_ADJ, ScoringConfig(adjacency_across_words=True)),
    "tajweed": _scored_sql("tajweed_bonus shadda_hard_count madd_guttural_count idgham_count"),
    "no_tajweed": _scored_sql("tajweed_bonus idgham_count raw_score", ScoringConfig(enable_tajweed=False)),
    "density_word": _scored_sql("raw_score density_score"),
    "density_letter": _scored_sql("density_score density_per_letter", ScoringConfig(density_basis="letter")),
    "scored_table": _scored_sql(" ".join(SCORED[2:]), None, True),
    "custom_weights": _scored_sql(" ".join(SCORED[4:]), CUSTOM, True),
    "zero_bonus": _scored_sql(" ".join(SCORED[4:]), NO_BONUS),
    "topk_raw": _scored_sql("text raw_score density_score", None, True, f"ORDER BY raw_score DESC, density_score DESC, ord LIMIT {TOP}"),
    "topk_density": _scored_sql("text raw_score density_score", None, True, f"ORDER BY density_score DESC, raw_score DESC, ord LIMIT {TOP}"),
    "parse_lines": f"WITH {_view_sql()} SELECT CAST(ord AS BIGINT) AS ord, {_IDS}, regexp_replace(' ' || text || '|z ', '^{_WS}|{_WS}$', '', 'g') AS text FROM verses",
    "strip_opening": f"""WITH {_view_sql()}, led AS (SELECT ord, surah % 40 AS surah, ayah, {_LED} AS text FROM verses),{_chars_sql("led")},
hits AS (SELECT ord FROM base WHERE ayah = 1 AND surah NOT IN (1, 9) AND word_count > 4 AND array_to_string(string_split(key, ' ')[1:4], '') = 'بسماللهالرحمنالرحيم')
SELECT CAST(led.ord AS BIGINT) AS ord, {_IDS}, CASE WHEN h.ord IS NOT NULL THEN array_to_string(t[5:], ' ') ELSE text END AS text, h.ord IS NOT NULL AS stripped FROM led LEFT JOIN hits h ON led.ord = h.ord JOIN toks ON led.ord = toks.ord""",
}


_ENDS = r"[\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
_CSV_TEXT = "replace(text, chr(13), '')"
ORACLE |= {
    "words": f"WITH {_view_sql(True)},{_chars_sql()}, l AS (SELECT ord, string_agg(letter, '/' ORDER BY ti, ci) AS letters FROM cl GROUP BY ord) SELECT {_IDS}, array_to_string(t, '/') AS words, coalesce(letters, '') AS letters FROM verses JOIN toks ON verses.ord = toks.ord LEFT JOIN l ON verses.ord = l.ord",
    "letter_classes": f"""WITH {_view_sql(True)}, c AS (SELECT unnest(string_split(text, '')) AS ch FROM verses WHERE text <> ''), g AS (SELECT ch, count(*) AS n, unicode(ch) AS cp, translate(ch, '{C.FOLD_FROM}', '{C.FOLD_TO}') AS norm FROM c GROUP BY ch)
SELECT ch, n, cp BETWEEN 1611 AND 1631 OR cp = 1648 OR cp BETWEEN 1750 AND 1773 OR cp BETWEEN 2288 AND 2303 AS mark, strpos('{C.BASE}', ch) > 0 AS base, CASE WHEN strpos('{C.BASE}', norm) > 0 THEN norm END AS letter FROM g""",
    "corpus_counts": f"SELECT count(*) AS verse_count, count(*) FILTER (stripped) AS basmala_stripped FROM ({ORACLE['strip_opening']})",
    "corpus_json": f"WITH {_view_sql()},{_chars_sql()} SELECT row_number() OVER (ORDER BY ord) - 1 AS ord, {_IDS}, text, CAST(word_count AS BIGINT) AS word_count FROM base",
    "raw_file": f"WITH {_view_sql()} SELECT (row_number() OVER (ORDER BY ord) - 1) * 5 AS ord, {_IDS}, regexp_replace(' ' || regexp_replace(text, '{_ENDS}', '', 'g') || '|z ', '^{_WS}|{_WS}$', '', 'g') AS text FROM verses",
    "csv_file": f"""WITH {_view_sql()},{_chars_sql()} SELECT 'surah,ayah,word_count,text' AS value UNION ALL
SELECT surah || ',' || ayah || ',' || word_count || ',' || CASE WHEN regexp_matches({_CSV_TEXT}, '[",]') THEN '"' || replace({_CSV_TEXT}, '"', '""') || '"' ELSE {_CSV_TEXT} END FROM base""",
    "ranked_rows": f"SELECT row_number() OVER (ORDER BY raw_score DESC, density_score DESC, ord) AS rank, {_IDS}, raw_score, density_score FROM ({_scored_sql('raw_score density_score ord')})",
    "dropped_in_order": _class_sql(f"SELECT CAST(CASE WHEN reason = 'word_count' THEN 1 WHEN reason = 'not_fully_diacritized' THEN 2 ELSE 3 END AS BIGINT) AS stage, CAST(ord AS BIGINT) AS ord, {_IDS}, reason FROM classified WHERE reason IS NOT NULL"),
    "sql_scored": ORACLE["scored_table"],
    "many_configs": " UNION ALL ".join(f"SELECT '{name}' AS config, surah, ayah, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' if c == 'density_score' else c for c in MANY_COLUMNS)} FROM ({_scored_sql(' '.join(MANY_COLUMNS), c, True)})" for name, c in MANY.items()),
    "dedup_batches": _class_sql(f"SELECT {_IDS}, reason FROM classified"),
    "dedup_stream": _class_sql(f"SELECT {_IDS}, reason FROM classified"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
