"""Large groups of near copies."""

import numpy as np
import pytest

from nutq.llm import jaccard

from . import brute


def group(seed, size, least, most):
    """Copies of one text without a few of its words, so many that each lost word is lost by several of them."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(120)]
    cuts = [set(rng.choice(120, rng.integers(least, most), replace=False).tolist()) for _ in range(size)]
    return [(i, " ".join(w for k, w in enumerate(base) if k not in cut)) for i, cut in enumerate(cuts)]


def test_candidates_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    """Copies too far apart to be linked with each other or with one centre, and hardly any link."""
    monkeypatch.setattr(jaccard, "LONG_LIST", 4, raising=False)
    verified, asked = jaccard.verified, []

    def counted(pairs, nodes):
        asked.append(pairs.count())
        return verified(pairs, nodes)

    monkeypatch.setattr(jaccard, "verified", counted)
    rows = group(21, 300, 5, 7)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    want, _ = brute.components(rows)
    assert [got[i] for i, _ in rows] == want
    assert asked[-1] < len(rows), asked


@pytest.mark.parametrize(("seed", "long_list"), [(0, 0), (1, 4)])
def test_links_of_long_lists_are_all_found(spark, monkeypatch, seed, long_list):
    """Groups around the threshold and pieces of others, with exact components, whichever way pairs meet."""
    monkeypatch.setattr(jaccard, "LONG_LIST", long_list)
    rng = np.random.default_rng(30 + seed)
    rows = group(seed, 60, 2, 8)
    rows += [(100 + i, t.replace("w", "v")) for i, t in group(40 + seed, 40, 3, 6)]
    words = [f"x{i}" for i in range(90)]
    for i in range(40):  # other lengths: a piece of one text, followed by other words
        n, k = rng.integers(60, 90), rng.integers(0, 12)
        rows.append((200 + i, " ".join(words[:n] + [f"y{i % 7}z{j}" for j in range(k)])))
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want, _ = brute.components(rows)
    assert [got[i] for i, _ in rows] == want
    assert len(set(want)) > 3
