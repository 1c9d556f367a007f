"""Lines of text files with their places, read in byte ranges.

Spark reads a file in splits; a row's place is the number of lines in the
splits before its own, summed from a first pass over the files, and its place
in its split.  No task reads more than its splits, and no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import by_split, checkpointed

#: The line ends of Python's ``splitlines`` besides those that Spark's reader splits at.
OTHER_ENDS = "[\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"


def ordered_rows(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """file, block, real, at, value: ``at`` grows with the place within a split, which starts at ``block``; ``real`` is the file's size."""
    about = {"file": "file_path", "block": "file_block_start", "real": "file_size"}
    return spark.read.text(path, **options).select(*[F.col(f"_metadata.{c}").alias(name) for name, c in about.items()], "value", F.monotonically_increasing_id().alias("at"))


def _last_byte(spark: SparkSession, file: str) -> int:
    jvm, path = spark.sparkContext._jvm, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(file))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.open(path)
    try:
        stream.seek(system.getFileStatus(path).getLen() - 1)
        return stream.read()
    finally:
        stream.close()


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """ord, value: all lines of the files at ``path``, counted on from file to file in the order of their names.

    Lines end as in Python's ``splitlines``.  The first pass, which counts the
    lines of each split, runs when this is called.  A gzip file is one split;
    an empty file has no lines; one line is one value in one task.
    """
    pieces = F.split("value", OTHER_ENDS, -1)
    # A line end at the very end of a file leaves an empty piece, unless Spark's reader ends lines there, too.
    marked = F.transform(pieces, lambda x, i: F.struct(x.alias("value"), ((i > 0) & (i == F.size(pieces) - 1) & (x == "")).alias("open")))
    rows = ordered_rows(spark, path).select("file", "block", F.explode(marked).alias("x")).select("file", "block", "x.value", "x.open")
    lines = rows.withColumn("at", F.monotonically_increasing_id())
    counted = checkpointed(lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.max("at").alias("last"), F.max_by("open", "at").alias("open")))
    last = counted.groupBy("file").agg(F.max(F.struct("block", "open")).alias("end")).where("end.open").select("file")
    gone = [r.file for r in last.collect() if not r.file.endswith(".gz") and _last_byte(spark, r.file) not in b"\r\n"]  # files that end so, with no other line end after it
    drop = F.col("open") & F.col("file").isin(gone) & (F.col("block") == F.max("block").over(W.partitionBy("file")))
    counted = counted.withColumn("drop", drop).withColumn("n", F.col("n") - F.col("drop").cast("long"))
    # One row for each split: sums within files first, then over files.
    inside = counted.withColumn("before", F.sum("n").over(W.partitionBy("file").orderBy("block")) - F.col("n"))
    files = counted.groupBy("file").agg(F.sum("n").alias("n"))
    files = files.select("file", (F.sum("n").over(W.orderBy("file")) - F.col("n")).alias("start"))
    splits = checkpointed(inside.join(files, "file").select("file", "block", "first", F.when(F.col("drop"), F.col("last")).alias("drop"), (F.col("start") + F.col("before")).alias("before")))
    placed = by_split(lines, splits).where("drop IS NULL OR at < drop")
    return placed.select((F.col("before") + F.col("at") - F.col("first")).alias("ord"), "value")
