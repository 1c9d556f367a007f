"""Sinks: scored rows, dropped rows, the configuration, a corpus with its manifest."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ScoringConfig
from ..operators.score import SCORED
from .corpus import SCRIPTS
from .exact import write_file
from .shared import hadoop_path, write_text_file

FORMATS = ("csv", "json", "parquet")


def _write(df: DataFrame, path: str, kind: str) -> str:
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.csv(path, header=True, escape='"', emptyValue="")
    elif kind == "json":
        writer.json(path, ignoreNullFields=False)
    else:
        writer.parquet(path)
    return path


def _note(spark: SparkSession, value: dict, path: str) -> str:
    spark.createDataFrame([(json.dumps(value, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def write_outputs(scored: DataFrame, dropped: DataFrame, config: ScoringConfig, out_dir: str, formats: list[str] | None = None, stem: str = "ayah_scores", single_files: bool = False) -> list[str]:
    """Write each output as a folder of part files, in parallel; the paths written.

    With ``single_files`` CSV and JSON are one file each, as Python's ``csv``
    and ``json`` write them.  Unknown formats are passed over.  Dropped rows
    and the configuration are written even when nothing was kept.
    """
    spark = scored.sparkSession
    write = lambda df, path, kind: write_file(df, path, kind) if single_files and kind != "parquet" else _write(df, path, kind)
    written = [write(scored.select(*SCORED), f"{out_dir}/{stem}.{kind}", kind) for kind in FORMATS if kind in (formats or ["csv", "json"])]
    written.append(write(dropped.select("surah", "ayah", "text", "reason"), f"{out_dir}/dropped_ayahs.csv", "csv"))
    written.append(_note(spark, config.to_json_dict(), f"{out_dir}/scoring_config.json"))
    return written


#: Verses of a whole script; another number is reported.
WHOLE_SCRIPT = 6236


def write_corpus(verses: DataFrame, script: str, out_dir: str, source: str = "", license: str = "", downloaded_at: str = "", raw: str = "") -> dict:
    """Write a parsed and stripped corpus as JSON lines and CSV, a copy of the raw text, and the manifest of all scripts in the folder.

    The JSON lines carry ``ord``, so that ``load_corpus`` reads them back in
    pieces.  Returns the script's entry; ``whole`` tells whether it has as many
    verses as a whole script.
    """
    if script not in SCRIPTS:
        raise ValueError(f"unknown script: {script!r}")
    spark = verses.sparkSession
    columns = verses.select("ord", F.col("surah").cast("string").alias("surah"), F.col("ayah").cast("string").alias("ayah"), "text")
    info = {"script": script, "description": SCRIPTS[script], "source": source, "license": license, "downloaded_at": downloaded_at or datetime.now(timezone.utc).isoformat(timespec="seconds")}
    if raw:
        info["raw"] = f"{out_dir}/{script}.txt"
        spark.read.text(raw).write.mode("overwrite").text(info["raw"])
    info |= {"json": _write(columns, f"{out_dir}/{script}.json", "json"), "csv": _write(columns.drop("ord"), f"{out_dir}/{script}.csv", "csv")}
    stripped = F.count_if("stripped") if "stripped" in verses.columns else F.lit(0)
    info["verse_count"], info["basmala_stripped"] = verses.agg(F.count("*"), stripped).first()
    info["whole"] = info["verse_count"] == WHOLE_SCRIPT
    _note(spark, info, f"{out_dir}/{script}.manifest")
    entries = [json.loads(r.value) for r in spark.read.text(f"{out_dir}/*.manifest").collect()]  # one for each script
    _note(spark, {"scripts": {e["script"]: e for e in entries}}, f"{out_dir}/manifest.json")
    return info


def write_corpora(verses: DataFrame, raw: dict[str, str], out_dir: str, source: str = "", license: str = "", downloaded_at: str = "") -> dict:
    """Write several scripts in one job, each with its raw copy, and the manifest of all scripts in the folder.

    ``verses`` has ``script`` beside the columns of one corpus.  Every run writes
    a folder of its own, dealt by script; the manifest, which says where each
    script lies, is written last and takes the old one's place in one step.
    So a run that is killed leaves the old manifest and all that it names as
    they were.  Scripts that this run does not have keep their entries.
    Returns the manifest.
    """
    if unknown := set(raw) - set(SCRIPTS):
        raise ValueError(f"unknown script: {sorted(unknown)[0]!r}")
    spark, run = verses.sparkSession, f"{out_dir}/run={uuid.uuid4().hex}"
    stripped = F.count_if("stripped") if "stripped" in verses.columns else F.lit(0)
    columns = ["script", "ord", F.col("surah").cast("string").alias("surah"), F.col("ayah").cast("string").alias("ayah"), "text"]
    # Dealt by script and place, so that a script is neither one task nor a small file of every task.
    dealt = verses.repartitionByRange("script", "ord")
    dealt.select(*columns).write.partitionBy("script").json(f"{run}/json")
    dealt.select(*columns).drop("ord").write.partitionBy("script").csv(f"{run}/csv", header=True, escape='"', emptyValue="")
    for script, path in raw.items():
        spark.read.text(path).write.text(f"{run}/raw/script={script}")
    counts = {r.script: r for r in verses.groupBy("script").agg(F.count("*").alias("n"), stripped.alias("s")).collect()}  # one row a script
    now = downloaded_at or datetime.now(timezone.utc).isoformat(timespec="seconds")
    entries = {}
    for script in raw:
        n, s = (counts[script].n, counts[script].s) if script in counts else (0, 0)
        where = {kind: f"{run}/{kind}/script={script}" for kind in ("json", "csv", "raw")}
        entries[script] = {"script": script, "description": SCRIPTS[script], "license": license, "downloaded_at": now, **where, "verse_count": n, "basmala_stripped": s, "whole": n == WHOLE_SCRIPT}
    manifest = {"source": source, "license": license, "downloaded_at": now, "scripts": read_manifest(spark, out_dir).get("scripts", {}) | entries}
    write_text_file(spark, json.dumps(manifest, ensure_ascii=False, indent=2), f"{out_dir}/manifest.json")
    return manifest


def read_manifest(spark: SparkSession, out_dir: str) -> dict:
    """The manifest of a folder; empty where there is none."""
    system, at = hadoop_path(spark, f"{out_dir}/manifest.json")
    if not system.exists(at):
        return {}
    return json.loads("\n".join(r.value for r in spark.read.text(f"{out_dir}/manifest.json", wholetext=True).collect()))  # one entry a script
