import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size int, label string, held_out string, node string"
LABELS = "doc_id long, quality int, toxic int, text string"


def make_rows(seed=5):
    """Documents with nulls, empty and long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ti", "on", "er", "an", "the", "Sh", "é", "x'", "9"]) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", "", ",", "."])
    text = lambda n: "".join(word() + rng.choice([" ", " ", "  ", "\n", "\t"]) for _ in range(n))
    passage, texts = text(70), [text(rng.randint(1, 300)) for _ in range(60)]
    for i in range(0, 40, 4):
        texts.append(texts[i])  # exact copies
        w = texts[i + 1].split()
        w[len(w) // 2] = "changed"
        texts.append(" ".join(w))  # near copies
        texts.append(texts[i + 2] + passage + text(5))  # a passage that repeats
    texts += [None, "", " \n", "one", "one two three", "one two three", "the " * 400, "the " * 300, text(9000), "a" * 20_000, "‘quoted’ 　 text 漢字 🙂 it's 1234567"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, t, "en", rng.choice(["a", "b", "c", "b", "b", None]), None) for i, t in zip(ids, texts, strict=True)]
    rows += [rows[3], rows[3], (None, texts[5], None, None, 3), (None, None, None, None, None)]
    return [(*r, "x", 1, None, "h", "n") for r in rows]


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, rows):
    known = [(r[0], int(r[0] % 3 > 0), int(r[0] % 5 == 0), "t") for r in rows if r[0] is not None and r[0] % 2]
    return spark.createDataFrame([*known, (None, 1, 1, None), (4, None, None, None)], LABELS)
