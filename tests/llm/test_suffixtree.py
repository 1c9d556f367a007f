"""The whole suffix tree against one over plain dictionaries."""

import zlib
from collections import Counter, defaultdict
from math import log, log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from nutq.llm import kernel, suffixtree

from . import brute

END = None


def plain_scores(rows, most_depth):
    """log10 score of each text, and the kept states' contexts."""
    texts = [[*brute.words(t, True), END] for _, t in rows]
    train = [t for (i, _), t in zip(rows, texts, strict=True) if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for t in train for w in t)
    size = sum(count.values()) + len(count) + 1
    states = {}

    def prob(context, word, depth):
        for d in range(depth, 0, -1):
            if len(context) >= d and (s := states.get(tuple(context[-d:]))):
                return s[0][word] if word in s[0] else s[1] * prob(context, word, d - 1)
        return (count[word] + 1) / size

    for depth in range(1, most_depth + 1):
        follow = defaultdict(Counter)
        for t in train:
            for i in range(depth, len(t)):
                follow[tuple(t[i - depth : i])][t[i]] += 1
        new = {}
        for context, after in follow.items():
            n = sum(after.values())
            below = {w: prob(context, w, depth - 1) for w, k in after.items() if k >= suffixtree.LISTED}
            if n < suffixtree.CONTEXT or not below:
                continue
            weight = len(after) + 1
            mine = {w: (after[w] + weight * b) / (n + weight) for w, b in below.items()}
            rest, rest_below = max(1 - sum(mine.values()), 1e-9), max(1 - sum(below.values()), 1e-9)
            if n * (sum(p * log(p / below[w]) for w, p in mine.items()) + rest * log(rest / rest_below)) >= suffixtree.EVIDENCE:
                new[context] = (mine, rest / rest_below)
        states |= new
    return [sum(log10(prob(t[:i], t[i], most_depth)) for i in range(len(t))) for t in texts], states


@pytest.fixture(scope="module")
def table():
    """Common words, and rare phrases of which a corpus holds only a few copies."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        w = [f"w{min(int(x), 400)}" for x in rng.zipf(1.3, rng.integers(1, 120))]
        if i % 40 < 3:
            w[3:3] = [f"rare{i // 40}x{k}" for k in range(12)]
        rows.append((i, " ".join(w)))
    return rows


def test_scores_equal_a_plain_tree(spark, table, monkeypatch):
    monkeypatch.setattr(suffixtree, "EVIDENCE", 1.0)  # many states
    want, states = plain_scores(table, suffixtree.MOST_DEPTH)
    assert len(states) > 100
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    for hot in (suffixtree.HOT, 2.0):  # what is broadcast changes nothing
        monkeypatch.setattr(suffixtree, "HOT", hot)
        got = {r.doc_id: r.score for r in suffixtree.score(spark, df).collect()}
        assert [got[i] for i, _ in table] == pytest.approx(want, rel=1e-9)


def test_tree_grows_with_the_corpus(spark, table):
    """Contexts of a few occurrences stay states, however much else a corpus holds."""
    few = table[:40] * 3
    # What follows b depends on the word before it: contexts of one and of two words that have evidence of their own.
    many = [(1000 + i, f"a{i} b{i} c{i} x{i} b{i} d{i} " * 25) for i in range(6000)]
    size = []
    for rows in (few, few + many[:2000], few + many):
        m = suffixtree.model(spark, spark.createDataFrame(rows, "doc_id long, text string"))
        size.append(m.states)
    assert all(size[2][d] - size[1][d] > 1.9 * (size[1][d] - size[0][d]) > 3000 for d in (0, 1))


def test_long_contexts_become_states(spark):
    """A word that only the third word before it, or an earlier one, decides."""
    rng = np.random.default_rng(12)
    rows = [(i, " ".join(f"a{x} b c d{' e' * (x % 2)} f{x}" for x in rng.integers(0, 8, 12))) for i in range(60)]
    want, states = plain_scores(rows, suffixtree.MOST_DEPTH)
    assert max(map(len, states)) >= 4
    got = {r.doc_id: r.score for r in suffixtree.score(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == pytest.approx(want, rel=1e-9)
    two, _ = plain_scores(rows, 2)
    assert sum(got.values()) > 0.9 * sum(two)


def test_gram_keys_are_spark_hashes(spark):
    """What tasks call a gram and what Spark computes of its two parts are the same number."""
    parts = np.random.default_rng(13).integers(-(1 << 63), (1 << 63) - 1, (100, 2))
    parts[:2] = [[0, 0], [-1, 1]]
    got = spark.createDataFrame(parts.tolist(), "a long, b long").selectExpr("a", "b", "xxhash64(a, b) AS h").toPandas()
    assert (kernel.xxhash64(got.a.to_numpy().view(np.uint64), got.b.to_numpy().view(np.uint64)).view(np.int64) == got.h).all()


def test_bit_tables_hold_every_key(spark):
    keys = np.random.default_rng(14).integers(-(1 << 63), (1 << 63) - 1, 20_000)
    table = suffixtree.bits(spark.createDataFrame([(int(k),) for k in keys[:10_000]], "key long"))
    there = suffixtree.has(table, keys.view(np.uint64))
    assert there[:10_000].all() and there[10_000:].mean() < 0.06


def test_answers_of_a_slice_are_packed():
    """A task answers with a row for each part of the texts, not for each text, and the sums come out the same."""
    rng = np.random.default_rng(15)
    own = ["_row", "n_tokens"]
    kinds = {**dict.fromkeys(own, pa.int64()), "_slice": pa.int32(), "_kind": pa.int32(), "_start": pa.int64(), "_keys": pa.binary(), "_data": pa.binary()}
    keys = np.unique(rng.integers(1, 1 << 60, 500).astype(np.uint64))
    value, n, start = rng.random(len(keys)), 9000, 3 << 33
    asked, row = rng.integers(0, len(keys), 40_000), rng.integers(0, n, 40_000).astype(np.uint32)
    batches = []
    for kind, of, data in ((suffixtree._TREE, keys, value), (suffixtree._GRAMS, keys[asked], row)):
        for columns in suffixtree._packs(kind, start, of, data, 1):
            batches.append(pa.RecordBatch.from_arrays([*[pa.nulls(len(columns[0]), pa.int64())] * 2, *columns], names=list(kinds)))
    ids = np.arange(start, start + n)
    text = {"_row": ids, "n_tokens": np.ones(n, np.int64), "_slice": np.zeros(n, np.int32), "_kind": np.full(n, suffixtree._TEXT, np.int32)}
    batches.append(pa.RecordBatch.from_arrays([pa.array(text[c], k) if c in text else pa.nulls(n, k) for c, k in kinds.items()], names=list(kinds)))
    made = pa.Table.from_batches(suffixtree._answers(own, -1.0)(iter(batches)))
    answers, texts = (made.filter(x) for x in (pc.is_null(made["n_tokens"]), pc.is_valid(made["n_tokens"])))
    assert len(answers) <= 4 and len(texts) == n
    dealt = pa.concat_tables([answers, texts]).sort_by("_part").to_pandas().assign(text=lambda x: x.n_tokens.notna()).sort_values(["_part", "text"], kind="stable").drop(columns="text")
    found = pa.Table.from_batches(suffixtree._totals(own)(iter(pa.Table.from_pandas(dealt, made.schema, preserve_index=False).combine_chunks().to_batches())))
    assert found["_row"].to_numpy().tolist() == ids.tolist()
    assert found["_above"].to_numpy() == pytest.approx(np.bincount(row, value[asked], n))
    assert not found["_unknown"].to_numpy().any()


def test_hot_contexts_change_nothing(spark, table, monkeypatch):
    """Contexts and suffixes are grown in their slices, or summed up over all tasks if frequent, with one result."""
    rows = table[:150]
    want, _ = plain_scores(rows, 2)
    monkeypatch.setattr(suffixtree, "ALONE", 0.02)  # words that are and that are not
    got = {r.doc_id: r.score for r in suffixtree.score(spark, spark.createDataFrame(rows, "doc_id long, text string"), most_depth=2).collect()}
    assert [got[i] for i, _ in rows] == pytest.approx(want, rel=1e-9)


def test_order_of_hashes_with_equal_first_bits():
    keys = np.random.default_rng(16).integers(0, 50, 3000).astype(np.uint64)
    keys[::3] += np.uint64(7 << 60)
    assert (kernel.ascending(keys) == np.argsort(keys, kind="stable")).all()
    assert not len(kernel.ascending(keys[:0]))
