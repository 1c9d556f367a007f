import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

from . import brute

tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def folder(spark, docs, labels, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    docs.select(*P.COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, folder)
        assert docs.columns == before.columns, name
        docs = P.write_table(spark, docs)
    assert P.STAGES[-1][1](spark, docs, folder).count() == docs.count() > 0


def test_one_document_of_each_group_stays(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = P.near_duplicates(spark, docs, folder).collect()
    component, size = brute.components([(r[0], r[1]) for r in rows])
    want = {c for c, n in zip(component, size, strict=True) if n} | {None}
    assert {r.doc_id for r in got if brute.words(r.text)} | {None} == want
    assert sum(not brute.words(r.text) for r in got) == size.count(0)


def test_passages_go(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = sorted((repr(r.doc_id), " ".join(brute.words(r.text))) for r in P.repeated_passages(spark, docs, folder).collect())
    want = sorted((repr(r[0]), " ".join(kept)) for r, (_, kept) in zip(rows, brute.without_passages([(r[0], r[1]) for r in rows]), strict=True))
    assert got == want


def test_whole_run_equals_the_stages_by_hand(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = P.quality_filter(spark, docs, folder).collect()
    table = [(r.doc_id, r.text) for r in good]
    component, size = brute.components(table)
    seen, kept = set(), []
    for (i, t), c, n in sorted(zip(table, component, size, strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        if not n or c not in seen:
            kept.append((i, t))
            seen |= {c} if n else set()
    cut = [(i, " ".join(w)) for (i, _), (_, w) in zip(kept, brute.without_passages(kept), strict=True)]
    out = P.run(spark, folder)
    ids = {r.doc_id for r in out.collect()}
    assert ids <= {i for i, t in cut if t} and len(ids) > len(cut) // 2
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert out.where(F.col("decoded_sha256") == hashlib.sha256(b"").hexdigest()).count() == 0


def test_empty_tables(spark, empty, labels, tmp_path):
    empty.select(*P.COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
