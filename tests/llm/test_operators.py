import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from nutq.llm import bpe, jaccard, kernel, mixing, progressive, quality, sharding, sketch, substrings, suffixtree, topk, toxicity

from . import brute

tokenizers = pytest.importorskip("public_tokenizers")


def sorted_rows(rows):
    return sorted(rows, key=repr)


# 1 ---------------------------------------------------------------------------


def reference_encoder():
    import tiktoken

    ranks = bpe.load_ranks(tokenizers.path("byte_bpe_50k.tiktoken"))
    return ranks, tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_tokenizer_library(docs, rows, empty):
    _, own = reference_encoder()
    run = lambda df, **k: bpe.encode_decode(df, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN, **k)
    got = sorted_rows((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(docs).collect())
    want = []
    for doc_id, text, *_ in rows:
        ids = own.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted_rows(want)
    assert run(empty).collect() == []
    full = run(docs.where("doc_id = 7"), with_ids=True).first()
    assert bytes(full.decoded).decode() == next(r[1] for r in rows if r[0] == 7) and len(full.ids) == full.n_tokens


def test_merge_replay_on_overlaps():
    import tiktoken

    ranks, _ = reference_encoder()
    own = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(1)
    found = [b"", b"a" * 3000, b" " * 999] + ["".join(rng.choice(list("aab ethné\n"), rng.integers(1, 50))).encode() for _ in range(3000)]
    for word, ids in zip(found, bpe.MergeReplay(ranks).encode_words(found), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(word.decode())


# 2 ---------------------------------------------------------------------------


@pytest.mark.parametrize("sizes", [[], [0], [10, 0, 5], [100, 1, 1, 1, 1000], [7] * 9, [1, 100_000, 3]])
def test_targets(sizes):
    assert mixing.targets(sizes) == pytest.approx(brute.targets(sizes) if sizes else [])


def test_permutations():
    for n in (1, 2, 5, 64, 1000):
        out = [mixing.permute(np.arange(n), np.full(n, n), np.full(n, key)) for key in (3, 4)]
        assert all(sorted(x.tolist()) == list(range(n)) for x in out)
    assert out[0].tolist() != out[1].tolist()


def test_mix(spark, docs, rows, empty):
    got = mixing.mix(spark, docs).collect()
    assert sorted_rows((r.doc_id, r.size) for r in got) == sorted_rows((r[0], len(brute.words(r[1]))) for r in rows)
    assert sorted_rows(mixing.mix(spark, docs.repartition(5)).collect()) == sorted_rows(got)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    by_source = defaultdict(int)
    for r in rows:
        by_source[r[3]] += len(brute.words(r[1]))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, brute.targets([by_source[s] for s in names]), strict=True))
    of_size = {by_source[s]: want[s] for s in names}
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(of_size[r.source_size])
        taken[r.source_size] += r.taken
    for size, target in of_size.items():
        assert taken[size] == pytest.approx(target, rel=0.03)
    assert mixing.mix(spark, empty).collect() == []


def test_mixed_texts_hold_the_words_taken(spark, docs):
    for r in mixing.mix(spark, docs, keep=("doc_id", "lang"), with_text=True).collect():
        assert len(brute.words(r.text)) == r.taken


# 3, 9 ------------------------------------------------------------------------


def test_folding():
    assert toxicity.fold("1d10t! Wоrthless, st@ck 100% ＩＤＩＯＴ don’t!!") == " idiot worthless stack 100 idiot don t "
    assert toxicity.fold("id\u200biot i\u00addiot i\u0301diot") == " idiot idiot idiot "


def test_toxicity_learns_words_beginnings_and_exceptions(spark, empty, labels):
    rng = np.random.default_rng(3)
    plain = [f"w{i}a" for i in range(300)]
    text = lambda *extra: " ".join([*rng.choice(plain, 80), *extra])
    data = []
    for i in range(900):
        toxic = i % 4 == 0
        bad = rng.choice(["vilest", f"grobian{rng.choice(plain)}"]) if toxic else "vilest"
        data.append((i, text(bad) if toxic else text("not", "vilest", "ever") if i % 40 == 1 else text(), int(toxic)))
    data.append((9000, text("v1lеst"), 1))
    df, known = spark.createDataFrame(data, "doc_id long, text string, toxic int"), spark.createDataFrame([(i, y) for i, _, y in data[:-1]], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(spark, df, known).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (brute.remainder(i, 5) == 0) for i, r in got.items())
    held = [(r.predicted, data[i][2]) for i, r in got.items() if r.held_out and i < 900]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert got[9000].predicted == 1
    assert toxicity.score(spark, empty, labels).collect() == []
    assert {(r.predicted, r.score) for r in toxicity.score(spark, df.limit(3), labels.limit(0)).collect()} == {(0, 0.0)}
    again = {r.doc_id: r.score for r in toxicity.score(spark, df, known.unionByName(known)).collect()}
    assert again == pytest.approx({i: r.score for i, r in got.items()})  # repeated labels change nothing


def test_toxicity_takes_any_row(spark, docs, rows, labels):
    assert toxicity.score(spark, docs, labels).count() == len(rows)


def test_quality_separates_held_out_documents(spark, docs, rows, labels, empty):
    rng = np.random.default_rng(4)
    data = []
    for i in range(900):
        good = i % 4 > 0
        w = rng.choice(["tion", "her", "and", "of", "stand"], 60).tolist()
        data.append((i, " ".join(w) if good else "!! ".join(x.upper() for x in w) if i % 8 else " ".join(w[:1] * 60), int(good)))
    df, known = spark.createDataFrame(data, "doc_id long, text string, y int"), spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, quality int")
    got = quality.classify(spark, df, known).collect()
    held = [(r.predicted, data[r.doc_id][2]) for r in got if r.held_out]
    assert all(r.held_out == (brute.remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert quality.classify(spark, docs, labels).count() == len(rows)
    assert {r.score for r in quality.classify(spark, docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(spark, empty, labels).collect() == []


def test_isotonic():
    x, y = quality.isotonic(np.arange(5.0), np.array([0.0, 3, 1, 4, 4]), np.full(5, 4.0))
    assert len(x) == 3 and all(a < b for a, b in zip(y, y[1:], strict=False))


# 4 ---------------------------------------------------------------------------


def test_components_equal_brute_force(spark, docs, rows, empty):
    got = jaccard.near_duplicates(spark, docs).collect()
    component, size = brute.components([(r[0], r[1]) for r in rows])
    assert sorted_rows((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted_rows((r[0], n, c) for r, n, c in zip(rows, size, component, strict=True))
    stay = Counter(r.component_id for r in got if r.stays and r.n_shingles)
    assert set(stay.values()) == {1} and sum(not r.stays for r in got) == len(rows) - sum(stay.values()) - size.count(0)
    assert jaccard.near_duplicates(spark, empty).collect() == []


def test_no_link_is_lost_in_chains_and_crowds(spark):
    """Chains of documents that only neighbours link, and crowds around a base, against brute force."""
    rng = np.random.default_rng(8)
    data = []
    for c in range(12):
        w = [f"c{c}w{i}" for i in range(60)]
        for k in range(10):
            data.append(" ".join(w))
            for p in rng.integers(0, 60, 1 + c % 2):
                w[p] = f"x{c}k{k}p{p}"
    base = [f"b{i}" for i in range(120)]
    for k in range(60):
        w = list(base)
        for p in rng.integers(0, 120, 1 + k % 4):
            w[p] = f"y{k}p{p}"
        data.append(" ".join(w))
    table = [(i * 7 % 1009, t) for i, t in enumerate(data)]
    got = jaccard.near_duplicates(spark, spark.createDataFrame(table, "doc_id long, text string")).collect()
    component, _ = brute.components(table)
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, c) for (i, _), c in zip(table, component, strict=True))


def test_prefix_of_the_pair_shares_enough():
    """Any two sets that link share the smaller number of matches asked for."""
    rng = np.random.default_rng(9)
    for _ in range(500):
        n = int(rng.integers(1, 80))
        a = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.93], rng.integers(0, 1 << 60, rng.integers(0, 6)).astype(np.uint64)]))
        both = np.intersect1d(a, b)
        if not len(both) or 100 * len(both) < 80 * (len(a) + len(b) - len(both)):
            continue
        level = {int(x): int(rng.integers(1, 4)) if x in both else 0 for x in np.union1d(a, b)}
        (ma, pa_), (mb, pb) = (jaccard.prefix(s, np.array([level[int(x)] for x in s])) for s in (a, b))
        assert len(np.intersect1d(pa_, pb)) >= min(ma, mb)


# 5 ---------------------------------------------------------------------------


def test_shards(docs, rows, empty):
    got = sharding.shard(docs, 5).collect()
    want = sorted_rows((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted_rows((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots, size, texts = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
        texts[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(5))
    assert max(size.values()) - min(size.values()) <= 2 * max(r.size for r in got)
    assert sorted_rows(got) == sorted_rows(sharding.shard(docs.repartition(7), 5).collect())
    assert sharding.shard(empty).collect() == []


def test_hot_text_is_divided(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    size = Counter()
    for r in sharding.shard(df, 10).collect():
        size[r.shard] += r.size
    assert len(size) == 10 and max(size.values()) < 1.1 * min(size.values())


def test_sharding_is_native(docs):
    assert "Python" not in (plan := sharding.shard(docs)._jdf.queryExecution().executedPlan().toString()) and "Arrow" not in plan


# 6 ---------------------------------------------------------------------------


@pytest.mark.parametrize("with_text", [False, True])
def test_passages_equal_brute_force(spark, docs, rows, empty, with_text):
    got = substrings.dedup(spark, docs, with_text=with_text).collect()
    want = [(r[0], n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()) for r, (n, kept) in zip(rows, brute.without_passages([(r[0], r[1]) for r in rows]), strict=True)]
    assert sorted_rows((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted_rows(want)
    assert any(w[2] for w in want)
    if with_text:
        assert all(hashlib.sha256(" ".join(brute.words(r.text)).encode()).hexdigest() == r.kept_sha256 for r in got)
    assert substrings.dedup(spark, empty).collect() == []


def test_sketch_never_underestimates(spark):
    df = spark.range(2000).select(F.concat_ws(" ", F.lit("w"), (F.col("id") % 700).cast("string")).alias("text"))
    items = lambda column: (np.unique(kernel.words(column.slice(i, 1)).hash) for i in range(len(column)))
    import pyarrow as pa

    for shape in (sketch.Shape.of(10, 1, 2), sketch.Shape.of(3000, 4, 1, (2, 3, 60))):
        packed = sketch.build(df, shape, items)
        values = kernel.words(pa.array(["w", *[str(i) for i in range(700)]])).hash
        level = sketch.levels(shape, packed, values)
        true = np.array([2000] + [len(range(i, 2000, 700)) for i in range(700)])
        assert (level >= np.digitize(true, shape.levels)).all()
        never = kernel.words(pa.array([f"never{i}" for i in range(500)])).hash
        assert (sketch.levels(shape, packed, never) == 0).mean() > 0.8


# 7 ---------------------------------------------------------------------------


def test_topk_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    data = [(i, [float(x) for x in rng.normal(0, 0.2, 6)]) for i in range(400)]
    data += [(400 + i, data[50][1]) for i in range(40)] + [(50, data[50][1]), (900, [0.0] * 6), (901, [1.0] * 3), (950, [0.5, -0.5, 0.25])]
    data += [(1000, None), (1001, [None] * 6), (1002, [float("nan")] * 6), (1003, [float("inf")] * 6), (None, [1.0] * 6), (1050, [])]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "vec_id long, embedding array<float>, score string, rank int")
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in data if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for a, (q, x) in enumerate(good):
        if q % 50 == 0:
            best = sorted((-int(x @ y), c) for b, (c, y) in enumerate(good) if a != b and len(x) == len(y))[:5]
            want += [(q, k, c, -s) for k, (s, c) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in topk.search(spark, df).collect()) == sorted(want)
    monkeypatch.setattr(topk, "CANDIDATES", 40)  # many blocks of both sides
    monkeypatch.setattr(topk, "QUERIES", 2)
    assert sorted(tuple(r) for r in topk.search(spark, df).collect()) == sorted(want)
    assert topk.search(spark, df.limit(0)).collect() == []


def test_threshold_stops_early():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-3, 4, (5000, 4)).astype(float)
    vectors[77] = 1000

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, at):
            out = super().__getitem__(at)
            if isinstance(at, np.ndarray):
                Counted.read += len(at)
            return out

    order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
    best, score = topk.threshold_search(vectors.view(Counted), np.arange(5000), order, np.ones(4), 1)
    assert (best[0], score[0]) == (77, 4000) and Counted.read < 100


# 8 ---------------------------------------------------------------------------


def test_media_round_trip(docs, rows, empty):
    got = progressive.load_media(progressive.store(docs)).collect()
    want, feature = [], {}
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        data = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        want.append((doc_id, len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:])))
    assert sorted_rows((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == sorted_rows(want)
    for r in got:
        assert feature.setdefault(r.payload_sha256, (r.media_bytes, r.media_sha256, r.feature)) == (r.media_bytes, r.media_sha256, r.feature)
    assert progressive.load_media(progressive.store(empty)).collect() == []
    full = progressive.load_media(progressive.store(docs.where("doc_id = 3")), with_tensor=True).first()
    assert len(full.rgb) == np.prod(full.shape) and hashlib.sha256(full.payload).hexdigest() == full.payload_sha256


def test_media_that_cannot_be_read_gives_a_reason(spark, docs):
    good = bytes(progressive.store(docs.where("doc_id = 3")).first().media)
    files = [good, None, b"", b"no image", good[: len(good) // 2], good]
    df = spark.createDataFrame([(i, 1, f) for i, f in enumerate(files)], "doc_id long, n_bytes long, media binary").coalesce(1)
    got = sorted(progressive.load_media(df).collect())
    assert [r.reason is None for r in got] == [True, False, False, False, False, True]
    assert got[0].payload_sha256 == got[5].payload_sha256 and got[3].media_bytes == 8 and got[1].media_bytes is None


def test_coefficients_survive_any_bytes():
    rng = np.random.default_rng(6)
    data = [bytes(64), b"\x01" * 64, bytes([0] * 63 + [1]), b"\xff" * 640, *[rng.choice([0, 0, 0, 0, 1, 2, 255], 64 * n).astype(np.uint8).tobytes() for n in (1, 7, 40)], rng.integers(0, 256, 64 * 33).astype(np.uint8).tobytes()]
    images = [progressive.parse(x) for x in progressive.encode(data)]
    assert [progressive.payload(i, c) for i, c in zip(images, progressive.coefficients(images), strict=True)] == data


def test_inverse_transform_by_definition():
    rng = np.random.default_rng(7)
    coef = rng.integers(-40, 40, (1, 64))
    grid = np.zeros(64)
    grid[progressive.ZIGZAG] = coef[0]
    grid = grid.reshape(8, 8)
    scale = lambda k: np.sqrt(0.5) if k == 0 else 1.0
    want = [[sum(scale(u) * scale(v) * grid[v, u] * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16) for u in range(8) for v in range(8)) / 4 + 128 for x in range(8)] for y in range(8)]
    assert np.abs(progressive.samples(coef, (1,) * 64)[0] - np.clip(want, 0, 255)).max() <= 0.51


# 10 --------------------------------------------------------------------------


def test_suffix_tree_counts(spark, docs, rows, empty):
    n, want = brute.base_scores([(r[0], r[1]) for r in rows])
    got = suffixtree.score(spark, docs).collect()
    key = lambda x: (repr(x[0]), x[1], x[2], round(x[3], 6))
    assert sorted(map(key, ((r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in got))) == sorted(map(key, ((r[0], *w) for r, w in zip(rows, want, strict=True))))
    assert all(r.train_tokens == n and r.held_out == (brute.remainder(r.doc_id, 7) == 2) and r.score < 0 for r in got)
    assert suffixtree.score(spark, empty).collect() == []


def test_suffix_tree_learns_contexts_and_sums_to_one(spark):
    rng = np.random.default_rng(1)
    follow = {f"w{i}": [f"w{(i * 3 + k) % 40}" for k in range(2)] for i in range(40)}
    data = []
    for i in range(300):
        w = ["w0"]
        while len(w) < 60:
            w.append(str(rng.choice(follow[w[-1]])))
        data.append((i, " ".join(w)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    held = [r for r in suffixtree.score(spark, df).collect() if r.held_out]
    assert sum(r.score for r in held) > 0.5 * sum(r.base_score for r in held)
    tree, _, total, distinct = suffixtree.learn(spark, kernel.text_column(df, "doc_id"))
    seen = np.arange(len(tree.words))
    assert any(k.any() for k in tree.kept)
    for context in ([], [0], [1], [5, 3]):
        flat = np.concatenate([[*context, x] for x in seen]).astype(np.int64)
        first = np.arange(len(seen) + 1) * (len(context) + 1)
        p = 10 ** tree.log10(flat, first)[len(context) :: len(context) + 1]
        # what is left is the share of the one unseen token, scaled like every unlisted one
        left = 10 ** tree.log10(np.array([*context, -1], np.int64), np.array([0, len(context) + 1]))[-1] / (total + distinct + 1)
        assert p.sum() + left == pytest.approx(1, abs=1e-6)
