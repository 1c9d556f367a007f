"""Every verse as a valid line, with malformed and comment lines of each in between."""

from pyspark.sql import functions as F

from nutq import queries as Q
from nutq.sources import corpus


def test_every_verse_is_parsed_among_lines_to_skip(spark, sf_dir):
    verses = Q.verse_view(spark, sf_dir).select("ord", "surah", "ayah", "text")
    ids = [F.col("surah").cast("string"), F.col("ayah").cast("string")]
    valid = F.concat_ws("|", *ids, F.concat(F.lit(" "), "text", F.lit("|z ")))
    skipped = [F.concat(F.lit("# "), valid), F.concat_ws("|", F.lit("x"), ids[1], "text"), F.concat_ws("|", *ids), F.lit("")]
    lines = verses.select("ord", F.explode(F.array(valid, *skipped)).alias("value"))
    got = sorted(map(tuple, corpus.parse_lines(lines).select("ord", "surah", "ayah", "text").collect()))
    strip = lambda t: t.strip(" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85")
    assert [(o, s, a, strip(t)) for o, s, a, t in got] == sorted((r.ord, r.surah, r.ayah, strip(f" {r.text}|z ")) for r in verses.collect())
