"""Columns to carry along that are named like an operator's own give way to these; large components in exact search."""

import random

import pytest

from nutq.llm import bpe, progressive, suffixtree, topk, toxicity

tokenizers = pytest.importorskip("public_tokenizers")
CLASH = "doc_id long, text string, score string, n_tokens string, held_out string, predicted string, media string, n_bytes string, feature string, lang string"


@pytest.fixture(scope="module")
def clashing(spark):
    return spark.createDataFrame([(i, f"some words of text {i % 5}", *["x"] * 7, "en") for i in range(12)], CLASH)


def test_clashing_names_give_way(spark, clashing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int")
    keep = ("doc_id", "lang", "score", "n_tokens", "held_out", "predicted", "media", "n_bytes", "feature", "doc_id")
    encoded = bpe.encode_decode(clashing, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN, keep=keep)
    toxic = toxicity.score(spark, clashing, labels, keep=keep)
    tree = suffixtree.score(spark, clashing, keep=keep)
    media = progressive.load_media(progressive.store(clashing, keep=keep), keep=keep)
    for df, own in ((encoded, "n_tokens"), (toxic, "score"), (tree, "score"), (media, "feature")):
        assert len(set(df.columns)) == len(df.columns) and {"doc_id", "lang"} <= set(df.columns)
        rows = df.collect()
        assert len(rows) == 12 and all(r.lang == "en" and r[own] != "x" for r in rows)


def test_large_components_are_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 20)
    rng = random.Random(3)
    sizes = [1.0, 1e4, 1e6, 1e12, 1e16, 1e30]
    rows = [(i, [rng.uniform(-1, 1) * rng.choice(sizes) for _ in range(3)]) for i in range(150)] + [(200, [1e30, 1.0]), (201, [1e30, 2.0]), (250, [1.0, 1.0]), (202, [-1e30, 1e300])]
    clip = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    import math

    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    want = []
    for i, q in whole:
        if i % 50 == 0:
            scores = sorted((-clip(sum(a * b for a, b in zip(q, v, strict=True))), j) for j, v in whole if j != i and len(v) == len(q))[:5]
            want += [(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)]
    got = topk.search(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()
    assert sorted(map(tuple, got)) == sorted(want)
