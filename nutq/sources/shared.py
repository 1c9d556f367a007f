"""Small helpers for tables that all executors can read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of one row for each split of the files read is broadcast up to so many rows (about 20 MB).
MOST_SPLITS = 200_000


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; only where that is unset one under the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Rows as Parquet in the shared folder, for what reads them more than once."""
    path = f"{shared_root(df.sparkSession)}/nutq-{uuid.uuid4().hex}-rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_split(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Join rows of ``file, block`` to a checkpointed table of splits.

    Up to MOST_SPLITS it is broadcast and rows keep their order and place;
    beyond, rows are shuffled by split and sorted back by ``at``.
    """
    if splits.count() <= MOST_SPLITS:
        return rows.join(F.broadcast(splits), ["file", "block"])
    return rows.join(splits, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "at")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) by which the JVM reaches a path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Give a finished file the name of another, which it takes the place of in one step."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    how = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    how[0] = fs.Options.Rename.OVERWRITE
    system, at = hadoop_path(spark, target)
    if system.exists(at) and system.getFileStatus(at).isDirectory():
        system.delete(at, True)
    context = fs.FileContext.getFileContext(at.toUri() if at.toUri().getScheme() else spark.sparkContext._jvm.java.net.URI("file:///") if system.getScheme() == "file" else system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(fs.Path(source)), system.makeQualified(at), how)


def write_text_file(spark: SparkSession, text: str, path: str) -> None:
    """One small file, written beside its place first."""
    beside = f"{path}.new"
    system, at = hadoop_path(spark, beside)
    out = system.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    replace_file(spark, beside, path)
