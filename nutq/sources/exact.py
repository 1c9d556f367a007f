"""One CSV file or one JSON array, byte for byte as Python's ``csv`` and ``json`` write them.

Tasks write sorted parts in parallel; the commit joins them in their order into
a file beside the target, which then takes its name.  It copies through a small
buffer on the driver: what is exported this way is one file.
"""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import replace_file, shared_root


def _csv_lines(rows: list[list]) -> list[str]:
    out = []
    for row in rows:
        line = io.StringIO(newline="")
        csv.writer(line).writerow(row)
        out.append(line.getvalue()[:-2])
    return out


def _json_objects(rows: list[list], names: list[str]) -> list[str]:
    """Objects as they stand in an indented array after others, without their last bracket."""
    return [",\n  " + json.dumps(dict(zip(names, row, strict=True)), ensure_ascii=False, indent=2).replace("\n", "\n  ")[:-1] for row in rows]


def _lines(kind: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(map(list, zip(*(batch.column(c).to_pylist() for c in names), strict=True)))
            lines = _csv_lines(rows) if kind == "csv" else _json_objects(rows, names)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    return run


def write_file(ordered: DataFrame, path: str, kind: str) -> str:
    """Write a sorted frame as one file: ``csv`` with a header and CR LF, or ``json``, an array indented by two.

    The rows keep the order of the frame's partitions.  Without rows there is
    the header, or an empty array.
    """
    spark, names = ordered.sparkSession, ordered.columns
    lines = ordered.mapInArrow(_lines(kind, names), "value string")
    parts = f"{shared_root(spark)}/nutq-{uuid.uuid4().hex}-parts"
    lines.write.text(parts, lineSep="\r\n" if kind == "csv" else "}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, target, beside = (jvm.org.apache.hadoop.fs.Path(p) for p in (parts, path, f"{path}.{uuid.uuid4().hex}"))
    source, system = folder.getFileSystem(conf), target.getFileSystem(conf)
    files = [f for f in source.listStatus(folder) if f.getPath().getName().startswith("part-") and f.getLen()]
    files.sort(key=lambda f: int(f.getPath().getName().split("-")[1]))
    out = system.create(beside, True)
    try:
        if kind == "csv":
            out.write(bytearray((_csv_lines([names])[0] + "\r\n").encode()))
        else:
            out.write(bytearray(b"[\n" if files else b"[]"))
        for i, file in enumerate(files):
            stream = source.open(file.getPath())
            try:
                if kind == "json" and not i:
                    stream.seek(2)  # no comma before the first
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
            finally:
                stream.close()
        if kind == "json" and files:
            out.write(bytearray(b"\n]"))
    finally:
        out.close()
    replace_file(spark, beside.toString(), path)
    source.delete(folder, True)
    return path
