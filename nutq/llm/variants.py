"""Spelling variants: words one edit apart, found by scanning sorted lists with a banded edit matrix.

Two words of at most L code points that differ by one edit share their first
ceil(L / 2) code points or their last floor(L / 2).  So each word joins, for L its
length and one more, the sorted list of its beginning and, turned round, that
of its end.  A task scans each of its lists for many words at once.  A row of a
word's edit matrix belongs to a beginning of the list's words, three cells wide;
the next word of the list reuses the rows of the beginning that it shares with
the one before, and where a row has nothing below two, all words with that
beginning are skipped.  A list that many words share is split by one more code
point; pairs that differ in just that one have a list of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel

# Fixed values of the word rule: runs of these code points, all of one byte in Latin-1.
LETTERS = r"A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A list of more words is split, of long words one of fewer; lists of words that differ in one code point have about 90 at most.
MOST_WORDS = 20_000
LEAST_WORDS = 200
#: Cells (words times length) that a task scans at once.
MOST_CELLS = 2_000_000


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2, typo: int = 31) -> DataFrame:
    """word, n: lower-cased runs of letters and how often they occur, some of them with a code point deleted.

    A run is lower-cased in A-Z only; where ``typo`` divides the crc32 h of
    ``<doc_id>:<run>``, its code point h % length goes.  A null text has no
    runs, a null id is empty text.  Counts combine before the shuffle.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_length},}}"), 0)).alias("run"))
    run = runs.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = run.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"), F.length("run").alias("len"))
    at = (F.col("h") % F.col("len")).cast("int")
    word = F.when(F.col("h") % typo == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("len")))).otherwise(F.col("run"))
    return h.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _scan(chars: np.ndarray, length: np.ndarray, shared: np.ndarray, first: np.ndarray, end: np.ndarray, queries: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of all pairs at distance one: each query against its list.

    ``chars`` are the words of all lists, list by list and sorted; ``shared``
    is the beginning that each has in common with the one before in its list;
    ``first`` and ``end`` bound each query's list, whose words share ``start``
    code points with it.
    """
    n, width = chars.shape
    # For each word and depth, the next word that does not share that much.
    skip = np.empty((n, width + 2), np.int32)
    for depth in range(width + 2):
        stops = np.append(np.flatnonzero(shared < depth), n)
        skip[:, depth] = stops[np.searchsorted(stops, np.arange(n), side="right")] if depth else n
    own = np.pad(chars[queries], ((0, 0), (0, 3)))
    q_length = length[queries].astype(np.int64)
    rows = np.full((len(queries), width + 2, 3), 2, np.int8)
    at, depth = first.astype(np.int64), start.astype(np.int64)
    rows[np.arange(len(queries)), depth] = (1, 0, 1)
    found_q, found_w = [], []
    active = np.flatnonzero(at < end)
    while len(active):
        word, d = at[active], depth[active]
        ended = d == length[word]
        a, w, k = active[ended], word[ended], d[ended]
        place = q_length[a] - k + 1
        inside = (place >= 0) & (place <= 2)
        hit = np.zeros(len(a), bool)
        hit[inside] = rows[a[inside], k[inside], place[inside]] == 1
        found_q.append(a[hit])
        found_w.append(w[hit])
        at[a] = w + 1
        # The next row of those that are inside a word.
        a, w, k = active[~ended], word[~ended], d[~ended]
        c = chars[w, k]
        before = rows[a, k]
        left = before[:, 0] + (c != own[a, np.maximum(k - 1, 0)])
        left = np.minimum(np.where(k > 0, left, 2), before[:, 1] + 1)
        middle = np.minimum(np.minimum(before[:, 1] + (c != own[a, k]), left + 1), before[:, 2] + 1)
        right = np.minimum(before[:, 2] + (c != own[a, k + 1]), middle + 1)
        rows[a, k + 1, 0], rows[a, k + 1, 1], rows[a, k + 1, 2] = (np.minimum(x, 2) for x in (left, middle, right))
        lost = np.minimum(np.minimum(left, middle), right) > 1
        depth[a[~lost]] = k[~lost] + 1
        at[a[lost]] = skip[w[lost], k[lost] + 1]
        # Who moved to another word keeps the rows that it shares.
        moved = np.concatenate([active[ended], a[lost]])
        moved = moved[at[moved] < end[moved]]
        depth[moved] = shared[at[moved]]
        active = active[at[active] < end[active]]
    return np.concatenate([*found_q, np.empty(0, np.int64)]).astype(np.int64), np.concatenate([*found_w, np.empty(0, np.int64)]).astype(np.int64)


def _matrix(words: pa.Array, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of Latin-1 bytes, those of ``back`` turned round, and their lengths."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    length = np.array([len(w) for w in raw], np.int64)
    width = int(length.max(initial=1))
    flat = np.frombuffer(b"".join(w[::-1] if b else w for w, b in zip(raw, back.tolist(), strict=True)), np.uint8)
    chars = np.zeros((len(raw), width), np.uint8)
    chars[np.arange(width) < length[:, None]] = flat
    return chars, length


def _shared(chars: np.ndarray) -> np.ndarray:
    """The beginning that each word has in common with the one before."""
    out = np.zeros(len(chars), np.int64)
    same = chars[1:] == chars[:-1]
    out[1:] = np.where(same.all(axis=1), chars.shape[1], same.argmin(axis=1))
    return out


def _pairs_of(lists: pa.Table) -> pa.RecordBatch | None:
    """word, near, near_n of whole lists: one row each way for every pair that belongs to its list."""
    columns = {c: lists.column(c).combine_chunks() for c in lists.column_names}
    top, depth, back, exact = (columns[c].to_numpy(zero_copy_only=False) for c in ("longest", "depth", "back", "exact"))
    chars, length = _matrix(columns["word"], back)
    new = _starts(columns)
    number = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    end = np.append(first[1:], len(new))
    shared = _shared(chars)
    shared[first] = 0
    shared = np.minimum(shared, np.minimum(length, np.append(0, length[:-1])))
    queries = np.flatnonzero((length == top) & ((end - first) > 1)[number])
    mine, w = _scan(chars, length, shared, first[number[queries]], end[number[queries]], queries, depth[queries].astype(np.int64))
    q = queries[mine]
    if not len(q):
        return None
    # A pair has one list: of its beginning if it shares one, and of its one differing code point if it has that.
    common = _agree(chars, length, q, w, forward=True)
    forward = np.where(back[q], _agree(chars, length, q, w, forward=False), common)
    good = np.where(back[q], forward < (top[q] + 1) // 2, True) & (~exact[q] | (common == depth[q]))
    q, w = q[good], w[good]
    shorter = length[w] < top[w]  # no query itself
    word = np.concatenate([q, w[shorter]])
    near = np.concatenate([w, q[shorter]])
    take = lambda c, rows: columns[c].take(pa.array(rows))
    return pa.RecordBatch.from_arrays([take("word", word), take("word", near), take("n", near)], names=["word", "near", "near_n"])


def _agree(chars: np.ndarray, length: np.ndarray, q: np.ndarray, w: np.ndarray, forward: bool) -> np.ndarray:
    """How many code points two words have in common at their beginnings, or at their ends."""
    steps = np.arange(chars.shape[1])
    short = np.minimum(length[q], length[w])[:, None]
    at = lambda rows: chars[rows] if forward else chars[rows[:, None], np.maximum(length[rows][:, None] - 1 - steps, 0)]
    differ = (at(q) != at(w)) | (steps >= short)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), chars.shape[1])


def _starts(columns: dict[str, pa.Array]) -> np.ndarray:
    """Where a new list begins."""
    new = np.ones(len(columns["word"]), bool)
    if len(new) > 1:
        new[1:] = np.any([pc.not_equal(columns[c][1:], columns[c][:-1]).to_numpy(zero_copy_only=False) for c in ("longest", "depth", "back", "exact", "list")], axis=0)
    return new


def _scan_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists come sorted; whole ones are taken together up to MOST_CELLS."""
    held: list[pa.RecordBatch] = []
    cells = 0

    def flush(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, cells
        table = pa.Table.from_batches(held).combine_chunks()
        begin = _starts({c: table.column(c).combine_chunks() for c in table.column_names})
        cut = len(begin) if last else int(np.flatnonzero(begin)[-1])
        if cut:
            bounds = np.append(np.flatnonzero(begin[:cut]), cut)
            # Words of one length class lie together, so rows are about as wide as their words.
            widths = table.column("longest").combine_chunks().to_numpy(zero_copy_only=False)
            a = 0
            while a < len(bounds) - 1:
                b = a + 1
                while b < len(bounds) - 1 and widths[bounds[b]] == widths[bounds[a]] and (bounds[b + 1] - bounds[a]) * widths[bounds[a]] <= MOST_CELLS:
                    b += 1
                out = _pairs_of(table.slice(bounds[a], bounds[b] - bounds[a]))
                if out is not None:
                    yield out
                a = b
        held = table.slice(cut).to_batches()
        cells = 0

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            cells += batch.num_rows * 16
            if cells > MOST_CELLS:
                yield from flush(False)
    if held:
        yield from flush(True)


def near_words(spark: SparkSession, words: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """word, near, near_n: every ordered pair of words of ``word, n`` that one edit separates, once."""
    kind = words.select("word", F.col("n").cast("long").alias("n"), F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longest"))
    kind = kind.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    turned = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    top = F.col("longest")
    half = F.when(F.col("back"), F.floor(top / 2)).otherwise(F.ceil(top / 2)).cast("int")
    rows = kind.withColumns({"depth": half, "exact": F.lit(False)})
    begin = lambda upto: F.substring(turned, F.lit(1), upto)
    rows = rows.withColumn("list", begin(F.col("depth"))).where(F.length("word") >= F.col("depth"))
    names = ["longest", "depth", "back", "exact", "list"]
    done, limit = None, F.greatest(F.lit(min(most, LEAST_WORDS)), F.lit(16 * most) / F.greatest(top, F.lit(16)))
    while True:
        sizes = kernel.write_table(spark, rows.groupBy(*names).agg(F.count("*").alias("_size")).where((F.col("_size") > limit) & ~F.col("exact") & (F.col("depth") < top - 1)).select(*names))
        if sizes.isEmpty():
            break
        whole = rows.join(sizes, names, "left_anti")
        done = whole if done is None else done.unionByName(whole)
        split = kernel.write_table(spark, rows.join(sizes, names, "left_semi"))
        depth = F.col("depth")
        one = split.where(F.length("word") > depth).withColumns({"list": begin(depth + 1), "depth": depth + 1})
        rest = F.substring(turned, depth + F.length("word") - top + 2, top)
        just = split.withColumns({"exact": F.lit(True), "list": F.concat(begin(depth), F.lit(" "), rest)})
        rows = one.unionByName(just.select(*one.columns))
    rows = rows if done is None else done.unionByName(rows)
    dealt = rows.repartition(*names).sortWithinPartitions(*names, turned).select(*names, "word", "n")
    return dealt.mapInArrow(_scan_lists, "word string, near string, near_n long")


def group_variants(spark: SparkSession, docs: DataFrame, ratio: int = 10, least_length: int = 7, least_count: int = 2, typo: int = 31, most: int = MOST_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n: each word of the vocabulary, what it is a variant of, and the last of these.

    A word's form is the most frequent word one edit away (ties: the smallest
    in code-point order) if that occurs at least ``ratio`` times as often.  Roots
    follow forms to their end.  Null texts have no words; null ids are
    empty text in the hash; repeated rows count each; a very long text is
    split by the JVM in one task, a very long word is one row of a matrix;
    other columns are not read; an empty table gives no rows.
    """
    words = kernel.write_table(spark, vocabulary(docs, least_length, least_count, typo))
    best = near_words(spark, words, most).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("_less"), "near")).alias("_best"))
    joined = words.join(best, "word", "left")
    often = -F.col("_best._less")
    is_form = often >= F.col("n") * ratio
    formed = kernel.write_table(spark, joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("_best.near")).alias("form"), F.when(is_form, often).alias("form_n")))
    return _with_roots(spark, formed, ratio).select("word", "form", "root", "n", "n_near", "form_n")


def _with_roots(spark: SparkSession, formed: DataFrame, ratio: int) -> DataFrame:
    """Add the end of each word's chain of forms: counts grow by ``ratio`` a step, so a few doublings reach it."""
    links = kernel.write_table(spark, formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        stepped = kernel.write_table(spark, links.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        kernel.drop_table(spark, links)
        links = stepped.select("word", "root")
        if stepped.where("_moved").isEmpty():
            return formed.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))
