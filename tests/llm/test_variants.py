import random
import re
import zlib
from collections import Counter

import pytest

from nutq.llm import variants

from .conftest import SCHEMA


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(texts):
    """texts: (doc_id, text); every pair of words is compared."""
    count = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    count = {w: n for w, n in count.items() if n >= 2 and len(w) >= 7}
    near = {w: [v for v in count if distance_one(w, v)] for w in count}
    form = {w: min((v for v in near[w]), key=lambda v: (-count[v], v), default=None) for w in count}
    form = {w: v if v and count[v] >= 10 * count[w] else None for w, v in form.items()}
    out = []
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), form[w] and count[form[w]]))
    return sorted(out, key=repr)


def as_rows(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=repr)


def texts(seed=3):
    rng = random.Random(seed)
    letters = "abcdeÀÉßÿ×éz"
    bases = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 12))) for _ in range(25)] + ["a" * k for k in range(7, 12)] + ["ab" * 5, "ba" * 5, "a" * 300]
    words = []
    for w in bases:
        words += [w] * rng.choice([2, 30, 150])
        for _ in range(12):
            v, i = w, rng.randrange(len(w))
            for _ in range(rng.choice([1, 1, 2])):
                v = rng.choice([v[:i] + v[i + 1 :], v[:i] + rng.choice(letters) + v[i:], v[:i] + rng.choice(letters) + v[i + 1 :]])
            words += [v] * rng.choice([1, 2, 3, 14])
    words += ["chainaaaa"] * 2 + ["chainaaab"] * 100 + ["chainaabb"] * 1500 + ["UPPERcase", "upperCASE"]
    rng.shuffle(words)
    out = [(i, rng.choice([" ", ", ", "1", "\n"]).join(words[40 * i : 40 * i + 40])) for i in range(len(words) // 40 + 1)]
    return out + [(None, None), (None, "chainaaaa " * 3), (9999, ""), (9999, "short words"), (5, "x" * 20_000), (6, "x" * 20_000), out[3], out[3]]


@pytest.fixture(scope="module")
def made(spark):
    return spark.createDataFrame([(i, t, *["x"] * 2, 1, "s", 2, "l", "h", "n") for i, t in texts()], SCHEMA).repartition(3)


@pytest.mark.parametrize("most", [variants.MOST_WORDS, 2])
def test_variants_equal_all_pairs(spark, made, most):
    """Also where every list is split down to its last code point but one."""
    short = [(i, t) for i, t in texts() if most > 2 or len(t or "") < 20_000 and "a" * 50 not in (t or "")]
    docs = made if most > 2 else spark.createDataFrame([(i, t, *[None] * 8) for i, t in short], SCHEMA)
    got, want = as_rows(variants.group_variants(spark, docs, most=most)), plain(short)
    assert got == want
    assert any(r[2] not in (r[0], r[1]) for r in want) and sum(r[4] for r in want) > 100


def test_an_empty_table_has_no_words(spark, empty):
    assert variants.group_variants(spark, empty).collect() == []


def test_pairs_come_once_each_way(spark):
    words = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaaabaaa", "baaaaaaa", "aaaaaaab", "zzzzzzz"]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    for most in (variants.MOST_WORDS, 1):
        got = sorted((r.word, r.near, r.near_n) for r in variants.near_words(spark, df, most).collect())
        assert got == sorted((a, b, words.index(b)) for a in words for b in words if distance_one(a, b))
