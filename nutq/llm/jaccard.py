"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its 5-word shingles.  Sets are ordered rarest first,
by levels of a merged sketch of document counts and then by hash.  Two sets
that reach the threshold share at least ``l`` of their first
``n - ceil(0.8 n) + l`` shingles, for any ``l``.  Each document chooses its
``l``: a longer prefix is read from more posting lists, but candidates must
share ``l`` of its shingles, and the least estimated cost wins.  A pair needs
the smaller ``l`` of the two.  Shingles that no other document has come first,
so their number bounds what a set can share with any other.

Links are gathered in two steps, so that no group of near copies is expanded
into its pairs.  First every posting list links its members to one of them,
the one with the fewest shingles of its own, then to others; what is verified
forms components.  Then all
remaining pairs of *different* components that share enough prefix shingles
are verified, so no link between components is lost; of a pair, what both share
with the centre of the larger component bounds what they share with each
other, and pairs that cannot reach the threshold are left out.  In long
lists, where nearly all members share most shingles, pairs meet by what tells
both from the centre instead: a link needs a least overlap of these
differences, so they have prefixes of their own.  Verification computes the
exact intersection of both sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel, sketch

SHINGLE = 5
#: Similarity of at least NEAR / 100 links.
NEAR = 80
#: Document counts at which the sketch's levels begin, and what a shingle of each level costs in candidates.
LEVELS = (2, 5, 33)
LEVEL_COST = np.array([0.0, 1.0, 8.0, 120.0])
#: Counters for each shingle of the corpus, while they fit; more of them tell own shingles from shared ones more surely.
ROOM = 4
#: The most shingles a document asks to share.
MOST_MATCHES = 12
#: Cost of verifying a candidate, in posting entries.
VERIFY = 20.0
_SEEDS = (np.uint64(0x51ED270B0929F8C1), np.uint64(0x2545F4914F6CDD1D))
#: Choices of a posting list's member that the others are linked to, before pairs are taken.
HUB_ROUNDS = 3
#: Pairs of different components, for each posting entry, that end these rounds.
PAIRS_PER_POSTING = 100
#: Members of a posting list beyond which its pairs are found by what tells them from its centre.
LONG_LIST = 16
#: Words of 64 bits that say which shingles such a difference has.
SIGNATURE = 8


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Number in the batch and sorted distinct shingle hashes of each document that has words."""
    for first, last in kernel.chunks(column):
        w = kernel.words(column.slice(first, last - first), lower=True)
        value, begins = kernel.window_hashes(w, SHINGLE)
        cut = np.searchsorted(begins, w.first)
        n = np.diff(w.first)
        for doc, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
            if b > a:
                yield first + doc, np.unique(value[a:b])
            elif n[doc]:
                with np.errstate(over="ignore"):
                    x = w.hash[w.first[doc] : w.first[doc + 1]] * kernel.powers(kernel._WORD_MULTIPLIERS[0], n[doc])
                    yield first + doc, kernel.mix(np.array([x.sum(dtype=np.uint64) ^ np.uint64(n[doc])]))


def _items(column: pa.Array) -> Iterator[np.ndarray]:
    return (x for _, x in _sets(column))


def prefix(values: np.ndarray, level: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of matches a document asks for, and its prefix without shingles no other document has."""
    n = len(values)
    base = n - -(-NEAR * n // 100)
    order = np.lexsort((values, level))[: base + MOST_MATCHES]
    cost = np.concatenate([[0.0], np.cumsum(LEVEL_COST[level[order]])])
    best, matches = np.inf, 1
    for m in range(1, min(MOST_MATCHES, n - base) + 1):
        read = cost[min(base + m, len(order))]
        total = read + VERIFY * read / m
        if total < best:
            best, matches = total, m
    head = order[: base + matches]
    return matches, values[head[level[head] > 0]]


def _rows(shape: sketch.Shape, packed, keep: list[str]):
    """A row for each document: set size, class (128 bits of hash of the whole set), matches asked for, prefix where it may have partners, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            n = batch.num_rows
            size, matches, own = np.zeros(n, np.int64), np.zeros(n, np.int32), np.zeros(n, np.int64)
            whole = np.zeros((n, 2), np.uint64)
            heads: list[np.ndarray | None] = [None] * n
            for i, values in _sets(batch.column("text")):
                with np.errstate(over="ignore"):
                    whole[i] = [np.sum(kernel.mix(values ^ seed), dtype=np.uint64) + np.uint64(len(values)) for seed in _SEEDS]
                size[i] = len(values)
                level = sketch.levels(shape, packed.value, values)
                own[i] = np.count_nonzero(level == 0)
                matches[i], head = prefix(values, level)
                key = (int(whole[i, 0]), int(whole[i, 1]))
                if len(head) >= matches[i] and key not in sent:  # a task sends one of equal sets
                    heads[i] = head
                    if len(sent) < 1_000_000:
                        sent.add(key)
            whole = kernel.mix(whole).view(np.int64)
            flat = np.concatenate([x for x in heads if x is not None] or [np.empty(0, np.uint64)])
            at = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in heads])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))
            cols = [*map(batch.column, keep), pa.array(np.arange(row, row + n)), pa.array(size), *(pa.array(whole[:, k], mask=size == 0) for k in (0, 1)), pa.array(matches), pa.array(own), lists]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "_row", "n_shingles", "_c1", "_c2", "_matches", "_own", "_head"])
            row += n

    return run


def _read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(_sets(batch.column("text")))
        rows = batch.column("node").take(pa.array([i for i, _ in found], pa.int64()))
        yield pa.RecordBatch.from_arrays([rows, pa.array([x.tobytes() for _, x in found], pa.binary())], names=["node", "shingles"])


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles the sets x and y of each row share."""
    for batch in batches:
        both = [len(np.intersect1d(*(np.frombuffer(v.as_buffer(), np.uint64) for v in pair), assume_unique=True)) for pair in zip(batch.column("x"), batch.column("y"), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "n_a", "n_b")), pa.array(both, pa.int64())], names=["a", "b", "n_a", "n_b", "common"])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles that only one of the sets x and y of each row has."""
    for batch in batches:
        found, first = [], 0
        for i, pair in enumerate(zip(batch.column("x"), batch.column("y"), strict=True), 1):
            found.append(np.setxor1d(*(np.frombuffer(v.as_buffer(), np.uint64) for v in pair), assume_unique=True))
            if i == batch.num_rows or sum(map(len, found)) > kernel.CHUNK_BYTES // 8:
                row = pa.array(np.repeat(np.arange(first, i), [len(x) for x in found]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in ("node", "hub_root")), pa.array(np.concatenate(found).view(np.int64))], names=["node", "hub_root", "token"])
                found, first = [], i


def _with_ends(df: DataFrame, nodes: DataFrame, column: Column, *more: str) -> DataFrame:
    for end, name in (("a", "x"), ("b", "y")):
        df = df.join(nodes.select(F.col("node").alias(end), column.alias(name), *[F.col(c).alias(f"{c}_{end}") for c in more]), end)
    return df


def shared(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b, n_a, n_b, common: the sizes of both sets and how many shingles they share."""
    sets = _with_ends(pairs.select("a", "b"), nodes, F.col("shingles"), "n_shingles")
    return sets.select("a", "b", F.col("n_shingles_a").alias("n_a"), F.col("n_shingles_b").alias("n_b"), "x", "y").mapInArrow(_common, "a long, b long, n_a long, n_b long, common long")


def verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of the pairs a, b of nodes, those whose prefixes share enough and whose sets reach the threshold."""
    # Half of each hash is sent: shingles that agree by chance only let a pair pass to the exact test.
    head = F.transform("head", lambda x: F.shiftright(x["token"], 32).cast("int"))
    merged = F.size("x") - F.size(F.array_distinct("x"))  # of one prefix, by chance
    enough = F.size(F.array_intersect("x", "y")) + merged >= F.least("matches_a", "matches_b")
    likely = _with_ends(pairs.select("a", "b"), nodes, head, "matches").where(enough)
    return shared(likely, nodes).where(_links("n_a", "n_b", "common")).select("a", "b")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, root: the smallest node each node is linked to, by alternating large and small stars.

    Minima are tables before they are joined, so that adaptive execution can
    split the rows of a node with very many links.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kernel.materialize(spark, both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        # large star: larger neighbours go to the least one
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: the node and its smaller neighbours go to the least one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        edges = kernel.materialize(spark, small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def _close(a: str, b: str, most: Column) -> Column:
    """Sizes that can reach the threshold when at most so many shingles are shared."""
    return 100 * most >= NEAR * (F.col(a) + F.col(b) - most)


def _postings(nodes: DataFrame, roots: DataFrame | None) -> DataFrame:
    """A row for each shingle of the prefixes that may be the first one a pair shares: those of the shortest prefix."""
    heads = nodes.select("node", "n_shingles", "own", "head")
    rooted = heads.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")) if roots is not None else heads.withColumn("root", F.col("node"))
    last = F.col("n_shingles") - F.ceil(F.col("n_shingles") * NEAR / 100) - F.col("own")
    return rooted.select("node", "root", "n_shingles", "own", F.explode("head").alias("e"), last.alias("last")).select("node", "root", "n_shingles", "own", "e.place", "e.token", "last").where("place <= last").drop("last")


def _links(a: str, b: str, common: str) -> Column:
    """Sizes of two sets and of what they share that reach the threshold."""
    return 100 * F.col(common) >= NEAR * (F.col(a) + F.col(b) - F.col(common))


def _beside_centre() -> Column:
    """The most that two sets share whose parts in a centre are known: inside of the centre, and outside of it."""
    outside = F.least(*[F.greatest(F.col(f"n_shingles_{s}") - F.col(f"own_{s}") - F.col(f"common_{s}"), F.lit(0)) for s in "ab"])
    return F.least("common_a", "common_b") + F.when(F.col("common_a").isNotNull() & F.col("common_b").isNotNull(), outside)


def _apart(spark: SparkSession, opened: DataFrame, measured: DataFrame, nodes: DataFrame) -> DataFrame:
    """What tells the members of long lists from their list's centre: a row for each shingle that only one of both has, rarest first, as far as linked members must share one.

    Of two sets whose differences from the centre have d and e shingles and o
    in common, d + e - 2 o shingles are in one set only, and a link allows
    (100 - NEAR) / (100 + NEAR) of both sizes.  So o is bounded from below:
    a prefix of each difference holds the first shingle they share.  ``far``
    and ``near`` are its last places for partners that the centre does not
    link, and for others; of a pair, one at least is not linked with it.
    """
    fits = 100 * (F.col("n_shingles") - F.col("own")) >= NEAR * F.col("n_shingles")
    member = opened.where(fits).select("node", "root", "hub_root", "n_shingles", "own").distinct().join(measured, ["node", "hub_root"])
    member = member.withColumn("inside", F.col("linked") | (F.col("root") == F.col("hub_root"))).withColumn("delta", F.col("n_shingles") + F.col("n_centre") - 2 * F.col("common"))
    known = ("node", "root", "hub_root", "n_shingles", "own", "common", "inside", "n_centre", "delta")
    member = kernel.materialize(spark, member.where("delta > 0").select(*known, "centre"))
    ends = _with_ends(member.select(F.col("node").alias("a"), F.col("centre").alias("b"), "hub_root"), nodes, F.col("shingles"))
    each = kernel.write_table(spark, ends.select(F.col("a").alias("node"), "hub_root", "x", "y").mapInArrow(_differences, "node long, hub_root long, token long"))
    often = each.groupBy("hub_root", "token").agg(F.count("*").alias("n")).where("n > 1")
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(token, 58) as int))")
    signature = [F.bit_or(F.when(F.col("token").bitwiseAND(SIGNATURE - 1) == k, bit).otherwise(F.lit(0))).alias(f"bits{k}") for k in range(SIGNATURE)]
    # Those that nothing else of the list has come first and are only counted.
    rest = each.join(often, ["hub_root", "token"]).groupBy("node", "hub_root").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("rest"), *signature)
    bits = [f"bits{k}" for k in range(SIGNATURE)]
    placed = member.join(rest, ["node", "hub_root"]).select(*known, F.size("rest").alias("kin"), *bits, F.posexplode("rest").alias("at", "e"))
    span = 100 + NEAR
    least = F.greatest(F.lit(1), F.ceil(F.col("delta") - F.col("n_shingles") * (100 - NEAR) / NEAR))
    # Of a partner that is not linked with the centre the difference has a least size, too.
    beyond = F.floor((span * F.col("delta") + (100 - NEAR) * (F.col("n_centre") - F.col("n_shingles"))) / (2 * span)) + 1
    placed = placed.select(*known, "kin", *bits, (F.col("delta") - F.col("kin") + F.col("at")).alias("place"), F.col("e.token").alias("token"), (F.col("delta") - least).alias("near"), (F.col("delta") - F.greatest(least, beyond)).alias("far"))
    return placed.where(F.col("place") <= F.when(F.col("inside"), F.col("far")).otherwise(F.col("near"))).drop("n_centre")


def _alike(apart: DataFrame) -> DataFrame:
    """Pairs of different components whose differences from one centre share enough."""
    names = ("node", "root", "n_shingles", "own", "common", "inside", "delta", "place", "near", "far", "kin", *[f"bits{k}" for k in range(SIGNATURE)])
    one, two = (apart.select("hub_root", "token", *[F.col(c).alias(f"{c}_{s}") for c in names]) for s in "ab")
    within = [F.col(f"place_{s}") <= F.when(F.col(f"inside_{t}"), F.col(f"near_{s}")).otherwise(F.col(f"far_{s}")) for s, t in ("ab", "ba")]
    # A bit that only one side has is a shingle, at least, that the other lacks.
    lacks = [sum(F.bit_count(F.col(f"bits{k}_{s}").bitwiseAND(F.bitwise_not(f"bits{k}_{t}"))) for k in range(SIGNATURE)) for s, t in ("ab", "ba")]
    most = F.least(*[F.col(f"delta_{s}") - F.col(f"place_{s}") for s in "ab"], *[F.col(f"kin_{s}") - lack for s, lack in zip("ab", lacks, strict=True)])
    enough = 2 * (100 + NEAR) * most >= (100 + NEAR) * (F.col("delta_a") + F.col("delta_b")) - (100 - NEAR) * (F.col("n_shingles_a") + F.col("n_shingles_b"))
    meets = (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")) & ~(F.col("inside_a") & F.col("inside_b")) & within[0] & within[1] & enough & _close("n_shingles_a", "n_shingles_b", _beside_centre())
    return one.join(two, (one.hub_root == two.hub_root) & (one.token == two.token) & meets).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def links(spark: SparkSession, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, components) of distinct sets with their prefixes; links connect whatever is connected."""
    # Own shingles come first in the order and are shared with nothing, so they bound what a set can share.
    size = F.col("n_shingles") - F.col("own")
    found: DataFrame | None = None
    labelled, roots, last = _postings(nodes, None), None, None
    for turn in range(HUB_ROUNDS):
        # Lists whose members are not all of one component yet, and the member the others are linked to: first the most central one.
        by = [F.col("own")] if turn == 0 else []
        hub = F.struct(*by, F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("hub"), F.col("root").alias("hub_root"), F.col("n_shingles").alias("hub_n"), size.alias("hub_shared"))
        lists = labelled.groupBy("token").agg(F.min(hub).alias("hub"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token", "hub.hub", "hub.hub_root", "hub.hub_n", "hub.hub_shared")
        lists = kernel.write_table(spark, lists)
        near = (F.col("root") != F.col("hub_root")) & _close("n_shingles", "hub_n", F.least(size, "hub_shared"))
        pairs = labelled.join(lists, "token").where(near).select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        new = kernel.materialize(spark, verified(pairs, nodes))
        kernel.drop_table(spark, lists)
        found = new if found is None else found.unionByName(new)
        roots = components(spark, found)
        labelled = _postings(nodes, roots)
        # Pairs of different components that lists still hold: few enough, and all are taken at once.
        by_root = labelled.groupBy("token", "root").agg(F.count("*").alias("k")).groupBy("token").agg(F.sum("k").alias("all"), F.sum(F.col("k") * F.col("k")).alias("same"))
        left, rows = by_root.agg(F.sum((F.col("all") * F.col("all") - F.col("same")) / 2), F.sum("all")).first()
        if turn and (left or 0) == last or (left or 0) <= PAIRS_PER_POSTING * (rows or 0):
            break
        last = left
    # Every pair of different components that may reach the threshold, at a shingle that may be their first common one.
    hub = F.struct("own", F.xxhash64("node").alias("h"), F.col("root").alias("hub_root"))
    lists = labelled.groupBy("token").agg(F.min(hub)["hub_root"].alias("hub_root"), F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")).where("low < high").select("token", "hub_root", "members")
    lists = kernel.write_table(spark, lists)
    opened = kernel.write_table(spark, labelled.join(lists, "token"))
    # What each member of a list shares with the centre of the list's large component bounds what two members share; a long list has a centre anyway.
    of_lists = opened.where(F.col("members") > LONG_LIST).select(F.col("hub_root").alias("node"), F.col("hub_root").alias("root"))
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).unionByName(of_lists).distinct()
    centre = members.join(nodes.select("node", "own"), "node").groupBy("root").agg(F.min(F.struct("own", F.xxhash64("node").alias("h"), F.col("node").alias("centre")))["centre"].alias("b"))
    seen = opened.select(F.col("node").alias("a"), F.col("hub_root").alias("root")).distinct().join(centre, "root")
    measured = shared(seen.select("a", "b"), nodes).distinct()
    measured = kernel.materialize(spark, seen.join(measured, ["a", "b"]).select(F.col("a").alias("node"), F.col("root").alias("hub_root"), F.col("b").alias("centre"), F.col("n_b").alias("n_centre"), "common", _links("n_a", "n_b", "common").alias("linked")))
    known = kernel.write_table(spark, opened.join(measured.drop("centre", "n_centre", "linked"), ["node", "hub_root"], "left"))
    one, two = (known.where(F.col("members") <= LONG_LIST).select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "root", "hub_root", "n_shingles", "own", "place", "common")]) for s in "ab")
    # Nothing before the first common shingle is shared; lists of later ones may lose the pair.
    most = F.least(*[F.col(f"n_shingles_{s}") - F.col(f"own_{s}") - F.col(f"place_{s}") for s in "ab"])
    most = F.least(most, _beside_centre())
    meets = (F.col("root_a") != F.col("root_b")) & ((F.col("root_b") == F.col("hub_root_a")) | (F.col("node_a") < F.col("node_b"))) & _close("n_shingles_a", "n_shingles_b", most)
    near = one.where("root_a <> hub_root_a").join(two, (one.token == two.token) & meets).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    apart = kernel.write_table(spark, _apart(spark, opened.where(F.col("members") > LONG_LIST), measured, nodes))
    near = near.unionByName(_alike(apart)).distinct()
    found = found.unionByName(measured.where("linked AND node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")))
    found = found.unionByName(kernel.materialize(spark, verified(near, nodes)))
    for table in (lists, opened, known, apart):
        kernel.drop_table(spark, table)
    return found, components(spark, found)


def _live(spark: SparkSession, table: DataFrame, classes: DataFrame) -> DataFrame:
    """One document of each class whose prefix holds a shingle of another class's prefix: node, sizes, those shingles with their places, set.

    Prefixes are counted by shingle, exactly, so that what is kept here does
    not depend on how full the sketch is.
    """
    heads = table.select(F.col("_row").alias("node"), "n_shingles", F.col("_matches").alias("matches"), F.col("_own").alias("own"), F.col("_head").alias("head")).where("size(head) > 0")
    heads = kernel.write_table(spark, heads.join(classes.select("node"), "node", "left_semi"))
    each = heads.select("node", F.posexplode("head").alias("place", "token"))
    common = kernel.write_table(spark, each.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token"))
    kept = each.join(common, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("head"))
    kept = kernel.write_table(spark, heads.drop("head").join(kept, "node"))
    kernel.drop_table(spark, common)
    kernel.drop_table(spark, heads)
    text = table.select(F.col("_row").alias("node"), "text").join(kept.select("node"), "node", "left_semi")
    nodes = kernel.write_table(spark, kept.join(text.mapInArrow(_read_sets, "node long, shingles binary"), "node"))
    kernel.drop_table(spark, kept)
    return nodes


def near_duplicates(spark: SparkSession, docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The component of each document under links of Jaccard 0.8 or more.

    Returns ``keep``, ``n_shingles``, ``component_id`` (the smallest id
    reachable, the document's own included), ``verified_links``, the number of
    other sets its set was verified to link with (no full count: pairs inside a
    component are mostly not verified), and ``stays``, true for one row of
    each component, the first by id.  Lower-cases A-Z.  A null or empty
    text has no shingles and is linked with nothing; a text of fewer than five
    words is one shingle; repeated rows are exact copies; a null id belongs to
    its component and stays null only where no id is reachable; a kept column
    named like a made one gives way to it; other columns are not read; an empty
    table gives no rows.
    """
    keep = kernel.kept_columns(keep, "n_shingles", "component_id", "verified_links", "stays")
    text = kernel.text_column(docs, *keep)
    shape = sketch.Shape.of(sketch.text_bytes(docs) // 6, ROOM, 1, LEVELS)
    packed = spark.sparkContext.broadcast(sketch.build(text, shape, _items))
    columns = [*(c for c in keep if c != "text"), "text"]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (text.schema[c] for c in columns))
    table = kernel.write_table(spark, text.mapInArrow(_rows(shape, packed, columns), f"{kept}, _row long, n_shingles long, _c1 long, _c2 long, _matches int, _own long, _head array<long>"))
    packed.destroy()
    # Class, then component, to its first row; minima are combined before they are shuffled.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    sends = F.min(F.when(F.size("_head") > 0, F.col("_row"))).alias("node")
    classes = kernel.write_table(spark, table.where("_c1 IS NOT NULL").groupBy("_c1", "_c2").agg(first.alias("first"), F.count("*").alias("rows"), sends))
    nodes = _live(spark, table, classes.where("node IS NOT NULL"))
    found, roots = links(spark, nodes)
    degree = found.distinct().select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    linked = kernel.write_table(spark, classes.where("node IS NOT NULL").join(degree, "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    best = kernel.materialize(spark, linked.groupBy("root").agg(F.min("first").alias("best")))
    alone = classes.where("rows > 1").join(linked.select("_c1", "_c2"), ["_c1", "_c2"], "left_anti").select("_c1", "_c2", F.col("first").alias("best"), F.lit(0).cast("long").alias("links"))
    label = kernel.write_table(spark, linked.join(best, "root").select("_c1", "_c2", "best", "links").unionByName(alone))
    for done in (classes, nodes, linked):
        kernel.drop_table(spark, done)
    out = [*keep, "n_shingles", F.coalesce("best.doc_id", "doc_id").alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("verified_links"), F.coalesce(F.col("best._row") == F.col("_row"), F.lit(True)).alias("stays")]
    # Documents without words have no class; they meet nothing.
    empty = table.where("_c1 IS NULL").select(*keep, "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("verified_links"), F.lit(True).alias("stays"))
    return table.where("_c1 IS NOT NULL").join(label, ["_c1", "_c2"], "left").select(*out).unionByName(empty)
