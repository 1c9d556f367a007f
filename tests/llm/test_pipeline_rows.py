"""The whole pipeline's rows against the chain by hand."""

import hashlib

import numpy as np
import pytest

import corpus_pipeline as P

from . import brute
from .test_operators import reference_encoder, sorted_rows
from .test_pipeline import folder  # noqa: F401

tokenizers = pytest.importorskip("public_tokenizers")


def is_taken_from(text, source):
    """Whether ``text`` is pieces of ``source`` in order, each repeated in its place."""
    words = brute.words(source)
    at = {(0, 0)}  # where the piece at hand may begin, and the place behind its last word
    for w in brute.words(text):
        steps = {(a, to) for a, p in at for to in {a, p}} | {(q, q) for q in range(min((p for _, p in at), default=len(words)), len(words))}
        at = {(a, to + 1) for a, to in steps if to < len(words) and words[to] == w}
    return bool(at)


def test_pieces():
    assert is_taken_from("a b a b c", "a b c d") and is_taken_from("b d d", "a b c d") and is_taken_from("", "a")
    assert not is_taken_from("b a", "a b c d") and not is_taken_from("c d b", "a b c d")


def test_whole_run_gives_the_rows_of_the_chain_by_hand(spark, folder):  # noqa: F811
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = P.write_table(spark, P.quality_filter(spark, docs, folder)).collect()
    component, size = brute.components([(r.doc_id, r.text) for r in good])
    seen, kept = set(), []
    for r, c, n in sorted(zip(good, component, size, strict=True), key=lambda x: (x[0].doc_id is None, x[0].doc_id or 0)):
        if not n or c not in seen:
            kept.append(r)
            seen |= {c} if n else set()
    cut = [(r, " ".join(words) if n > len(words) else r.text) for r, (n, words) in zip(kept, brute.without_passages([(r.doc_id, r.text) for r in kept]), strict=True)]
    frame = P.write_table(spark, spark.createDataFrame([(r.doc_id, t, r.lang, r.source, r.n_chars) for r, t in cut], docs.schema))
    mixed = P.mixing.mix(spark, frame, keep=P.COLUMNS, with_text=True).collect()
    source = {r.doc_id: t for r, t in cut}
    assert sorted_rows(r.doc_id for r in mixed) == sorted_rows(r.doc_id for r, _ in cut)
    for r in mixed:
        words = brute.words(r.text)
        assert len(words) == r.taken and set(words) <= set(brute.words(source[r.doc_id]))
        if r.size < 100:
            assert is_taken_from(r.text, source[r.doc_id])
    _, own = reference_encoder()
    want = []
    for r in mixed:
        if r.taken:
            ids = own.encode_ordinary(r.text)
            want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted_rows(tuple(r) for r in P.run(spark, folder).collect()) == sorted_rows(want)
