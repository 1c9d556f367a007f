"""Files read in byte ranges give what one reader of the whole file gives."""

import json
import random

import pytest

from nutq.sources import corpus
from nutq.sources.json_array import read_elements
from nutq.sources.lines import numbered_lines

ENDS = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " "]
SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=[48, 1 << 20])
def split(spark, request):
    spark.conf.set(SPLIT, str(request.param))
    yield request.param
    spark.conf.unset(SPLIT)


def write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as file:
        file.write(text)


def test_lines_across_splits(spark, tmp_path, split):
    rng = random.Random(split)
    texts = []
    for name in ("b", "a", "c"):
        text = "".join("".join(rng.choice("xyzé漢 ") for _ in range(rng.choice([0, 0, 1, 2, 9]))) + rng.choice(ENDS) for _ in range(25))
        texts.append((name, text + rng.choice(["", "no end", "\r"])))
        write(tmp_path / name, texts[-1][1])
    write(tmp_path / "d", "")
    want = [line for _, text in sorted(texts) for line in text.splitlines()]
    got = [(r.ord, r.value) for r in numbered_lines(spark, str(tmp_path)).orderBy("ord").collect()]
    assert got == list(enumerate(want))


def test_a_file_is_read_by_many_tasks(spark, tmp_path):
    write(tmp_path / "x", "1|1|a\n" * 2000)
    write(tmp_path / "x.json", json.dumps([{"surah": 1, "ayah": i, "text": "t"} for i in range(300)]))
    spark.conf.set(SPLIT, "1000")
    try:
        lines, array = corpus.read_lines(spark, str(tmp_path / "x")), corpus.load_corpus(spark, str(tmp_path / "x.json"))
        assert lines.rdd.getNumPartitions() >= 10
        assert [r.ord for r in lines.orderBy("ord").collect()] == list(range(2000))
        assert [(r.ord, r.ayah) for r in array.orderBy("ord").collect()] == [(i, i) for i in range(300)]
    finally:
        spark.conf.unset(SPLIT)


def elements(rng, n):
    odd = ['}', '"', "\\", '\\"', "{", "[", "]", '},{"surah": 9}', "é", "漢", "\n", ", ", "plain", "a" * 30, '"verses": [']
    return [{"surah": rng.choice([1, "2"]), "more": rng.choice([None, {"a": {"}": [1, {}]}}, [1, "]"]]), "ayah": i, "text": "".join(rng.choice(odd) for _ in range(rng.randint(0, 6)))} for i in range(n)]


FORMS = [
    lambda v: v,
    lambda v: {"script": 'a "verses": [{"}]', "notes": [{"text": "}"}, 3, "]"], "meta": {"verses": [{"surah": 3}], "b": {"c": {}}}, "verses": v, "after": {"x": [{}, {"y": "}"}], "verses": [1]}},
    lambda v: {"verses": v},
    lambda v: {"long": [{"k": "}" * 5, "i": i} for i in range(8)], "verses": v},
]


@pytest.mark.parametrize("form", range(len(FORMS)))
def test_arrays_across_splits(spark, tmp_path, split, form):
    rng = random.Random(form)
    want = []
    for name, n in (("a", 12), ("b", 0), ("c", 1)):
        verses = elements(rng, n)
        want += verses
        write(tmp_path / name, json.dumps(FORMS[form](verses), ensure_ascii=form == 2, indent=[None, 2][form % 2]) + rng.choice(["", "\n", " \n "]))
    got = [(r.ord, json.loads(r.value)) for r in read_elements(spark, str(tmp_path)).orderBy("ord").collect()]
    assert got == list(enumerate(want))


GOOD = '{"surah": 1, "ayah": 2, "text": "a } b"}'


@pytest.mark.parametrize(
    "text",
    ["", " ", "[", "]", "[" + GOOD, GOOD + "]", f"[{GOOD},]", f"[,{GOOD}]", f"[{GOOD} {GOOD}]", f"[{GOOD},,{GOOD}]", f"[1, {GOOD}]", f"[{GOOD}, 1]", f"[{GOOD}] x", f"[{GOOD}]]", f"[{GOOD}]}}", f'{{"verses": [{GOOD}]', f'{{"verses": [{GOOD}]}}}}', f'{{"verses": [{GOOD}], "verses": [{GOOD}]}}', f'{{"other": [{GOOD}]}}', '{"verses": 3}', f'{{"a": , "verses": [{GOOD}]}}', '{"verses": ["x}y"]}', '[{"surah": 1, "ayah": 2, "text": "cut', f'{{"n": [{GOOD} {GOOD}], "verses": []}}', f"[[{GOOD}]]", '[{"surah": 1 "ayah": 2}]'],
)
def test_what_is_no_corpus_is_an_error(spark, tmp_path, text):
    write(tmp_path / "x", text)
    spark.conf.set(SPLIT, "24")
    try:
        with pytest.raises(Exception, match="MALFORMED|no verses|without"):
            corpus.load_corpus(spark, str(tmp_path / "x")).collect()
    finally:
        spark.conf.unset(SPLIT)


def test_lines_of_verses_in_any_field_order(spark, tmp_path):
    write(tmp_path / "x", '{"text": "a } b", "ord": 4, "ayah": "2", "surah": 1}\n\n{"surah": 1, "ord": 5, "ayah": 3, "text": "c"}\n')
    assert [(r.ord, r.surah, r.ayah, r.text) for r in corpus.load_corpus(spark, str(tmp_path / "x")).orderBy("ord").collect()] == [(4, 1, 2, "a } b"), (5, 1, 3, "c")]
