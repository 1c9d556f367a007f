"""The registered queries of this subpackage: thin digests over its operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, jaccard, mixing, progressive, quality, sharding, substrings, suffixtree, topk, toxicity, variants, warc
from .kernel import load

RANKS = "byte_bpe_50k.tiktoken"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(load(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, load(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(spark, load(spark, sf_dir, "documents")).drop("stays", "verified_links")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(load(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(spark, load(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark, load(spark, sf_dir, "embeddings"))


def op8_progressive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progressive.load_media(progressive.store(load(spark, sf_dir, "documents"))).drop("reason")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op10_suffixtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score(spark, load(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, load(spark, sf_dir, "pages"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(spark, load(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark, load(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


#: The whole of a component's floor, and the rows that take part.
OP7_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 5
"""


_WORD = r"[^\x20\x09-\x0D]+"
#: Every pair of documents that share a shingle, then what is reachable by links.
OP4_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
g AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda p: array_to_string(w[p:p + 4], ' '))) END AS s FROM d),
e AS (SELECT r, len(s) AS n, unnest(s) AS x FROM g),
k AS (SELECT a.r AS a, b.r AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS nab FROM e a JOIN e b ON a.x = b.x AND a.r <> b.r GROUP BY ALL),
l AS (SELECT a, b FROM k WHERE 100 * nab >= 80 * (na + nb - nab)),
c(r, o) AS (SELECT r, r FROM g UNION SELECT c.r, l.b FROM c JOIN l ON c.o = l.a)
SELECT g.doc_id, any_value(len(g.s)) AS n_shingles, min(o.doc_id) AS component_id FROM g JOIN c ON g.r = c.r JOIN g o ON c.o = o.r GROUP BY g.r, g.doc_id
"""
#: Every window of every document, and each word that one of them covers.
OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
h AS (SELECT r, doc_id, list_transform(range(1, len(w) - 48), lambda p: md5(array_to_string(w[p:p + 49], ' '))) AS h FROM d WHERE len(w) >= 50),
v AS (SELECT r, doc_id, unnest(h) AS h, unnest(range(1, len(h) + 1)) AS p FROM h),
f AS (SELECT h, min(doc_id) AS least FROM v GROUP BY h),
b AS (SELECT DISTINCT r, p FROM v JOIN f USING (h) WHERE doc_id > least),
x AS (SELECT DISTINCT r, unnest(range(p, p + 50)) AS i FROM b),
t AS (SELECT r, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT r, count(*) AS n, string_agg(t, ' ' ORDER BY i) AS kept FROM t ANTI JOIN x USING (r, i) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""


#: Digests in base32 from 20 bits at a time; of equal payloads the last row by id is the original.
OP11_SQL = """
WITH p AS (SELECT row_number() OVER (ORDER BY page_id NULLS FIRST) AS r, page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, array_to_string(list_transform(range(8), lambda i: translate(to_base(('0x' || h[5 * i + 1:5 * i + 5])::BIGINT, 32, 4), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')), '') AS payload_digest FROM p),
o AS (SELECT *, max(r) OVER (PARTITION BY payload_digest) AS last, arg_max(page_id, r) OVER (PARTITION BY payload_digest) AS original FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN r = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN r < last THEN original END AS refers_to FROM o
"""

_CRC_STEP = "lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])"
#: The table of crc32 by its rule, words by theirs; pairs meet in what is left when one code point goes.
OP12_SQL = f"""
WITH RECURSIVE bits AS (SELECT i AS i, i AS v, 0 AS k FROM range(256) x(i) UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
raw AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{7,}}')) AS w FROM documents),
run AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n FROM raw GROUP BY ALL),
hashed AS (SELECT w, n, xor(list_reduce(list_transform(range(strlen(id || ':' || w)), lambda i: ('0x' || hex(encode(id || ':' || w))[2 * i + 1:2 * i + 2])::BIGINT), {_CRC_STEP}, 4294967295), 4294967295) AS h FROM run, tab),
word AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substring(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM word WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, unnest(range(length(word))) AS i FROM v),
less AS (SELECT word, n, i, left(word, i) || substring(word, i + 2) AS rest FROM cut),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, v.word, v.n FROM less l JOIN v ON l.rest = v.word
  UNION SELECT v.word, l.word, l.n FROM less l JOIN v ON l.rest = v.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS at FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NOT NULL),
root AS (SELECT c.word, c.at AS root FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN root USING (word)
"""


def _op13_sql(k: int = 8, rounds: int = 10) -> str:
    """Every distance to every centroid, round by round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"a{i} AS (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT e.r, m.c, list_sum(list_transform(list_zip(e.v, m.v), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS HUGEINT))) AS d FROM e, m{i} m) GROUP BY r)")
        if i < rounds:
            steps.append(f"s{i} AS (SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT a.c, unnest(e.v) AS x, unnest(range(len(e.v))) AS j FROM a{i} a JOIN e USING (r)) GROUP BY c, j)")
            steps.append(f"m{i + 1} AS (SELECT m.c, coalesce(w.v, m.v) AS v FROM m{i} m LEFT JOIN (SELECT c, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY j) AS v FROM s{i} GROUP BY c) w ON m.c = w.c)")
    return f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
m0 AS (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v FROM e ORDER BY c LIMIT {k}),
{", ".join(x.replace(" AS (", " AS MATERIALIZED (", 1) for x in steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN e USING (r) JOIN m{rounds} m USING (c)
"""


OP13_SQL = _op13_sql()


def oracle_sql() -> dict[str, str]:
    return {"op4_jaccard": OP4_SQL, "op6_substrings": OP6_SQL, "op7_topk": OP7_SQL, "op11_warc": OP11_SQL, "op12_variants": OP12_SQL, "op13_centroids": OP13_SQL}
