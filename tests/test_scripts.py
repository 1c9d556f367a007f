"""Several scripts in one run."""

import json

import pytest

from nutq import cli
from nutq.sources import corpus, sinks


def raw_files(tmp_path, scripts, text="ذلك"):
    out = {}
    for k, script in enumerate(scripts):
        path = tmp_path / f"{script}.txt"
        path.write_text("# licence\n2|1|بسم الله الرحمن الرحيم الم\n" + "".join(f"2|{i}|{text}\n" for i in range(2, 3 + k)), encoding="utf-8")
        out[script] = str(path)
    return out


def test_scripts_are_read_back(spark, tmp_path):
    raw, out = raw_files(tmp_path, list(corpus.SCRIPTS)[:3]), str(tmp_path / "out")
    manifest = cli.ingest_many(spark, raw, out, "S", "L")
    assert manifest == sinks.read_manifest(spark, out) == json.loads((tmp_path / "out/manifest.json").read_text(encoding="utf-8"))
    for k, (script, path) in enumerate(raw.items()):
        entry = manifest["scripts"][script]
        assert (entry["verse_count"], entry["basmala_stripped"], entry["whole"], entry["license"]) == (k + 2, 1, False, "L")
        back = corpus.load_corpus(spark, entry["json"]).orderBy("ord").collect()
        assert [(r.ord, r.surah, r.ayah, r.text) for r in back] == [(1, 2, 1, "الم"), *[(i, 2, i, "ذلك") for i in range(2, 3 + k)]]
        assert sorted(r.text for r in spark.read.csv(entry["csv"], header=True).collect()) == sorted(r.text for r in back)
        assert [r.value for r in spark.read.text(entry["raw"]).collect()] == open(path, encoding="utf-8").read().splitlines()


def test_a_killed_run_leaves_the_old_manifest_valid(spark, tmp_path, monkeypatch):
    names = list(corpus.SCRIPTS)[:2]
    raw, out = raw_files(tmp_path, names), str(tmp_path / "out")
    first = cli.ingest_many(spark, raw, out)
    new = raw_files(tmp_path, names, "تلك")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_text_file", killed)
        with pytest.raises(KeyboardInterrupt):
            cli.ingest_many(spark, new, out)
    assert sinks.read_manifest(spark, out) == first
    assert {r.text for r in corpus.load_corpus(spark, first["scripts"][names[1]]["json"]).collect()} == {"الم", "ذلك"}
    one = cli.ingest_many(spark, {names[0]: new[names[0]]}, out)  # the other script keeps its entry
    assert one["scripts"][names[1]] == first["scripts"][names[1]] and one["scripts"][names[0]] != first["scripts"][names[0]]
    assert {r.text for r in corpus.load_corpus(spark, one["scripts"][names[0]]["json"]).collect()} == {"الم", "تلك"}


def test_command_line(spark, tmp_path, capsys):
    raw_files(tmp_path, list(corpus.SCRIPTS)[:2])
    assert cli.main(["ingest", "--raw", str(tmp_path / "{script}.txt"), "--scripts", *list(corpus.SCRIPTS)[:2], "--out-dir", str(tmp_path / "out")]) == 0
    assert capsys.readouterr().out.count("verse_count") == 2
    with pytest.raises(ValueError, match="unknown script"):
        cli.ingest_many(spark, {"other": "x"}, str(tmp_path / "out"))
