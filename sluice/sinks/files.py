"""CSV outputs: rejects, loaded rows, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sluice.sinks import records

#: Rows of a file that is large enough, so that rows need not be brought together for it.
FILE_ROWS = 50_000
# Files that a task has open at a time; with more folders it sorts the rest of its rows.
_OPEN_FILES = 16


def write_csv(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partitions: int | None = None,
    by: str | None = None,
    even: bool = False,
    rows_per_file: float = 0,
    compression: str | None = None,
) -> None:
    """CSV with header. ``partitions`` sets the number of files (the rows lose their order); ``by``
    makes one folder per value.

    Folders are written after a rebalance: rows of one folder come together in files of even size,
    and a folder that holds most rows is split over tasks. ``even`` does so without folders, for
    few rows left over from many tasks; the rows lose their order. ``rows_per_file`` says how many rows a
    file has without that, if it is known: from ``FILE_ROWS`` on the rows are written where they are.
    ``compression`` names a codec that Spark's CSV reader knows by the ending of the file.
    """
    if partitions is not None:
        # Not coalesce: scan and filter above would run in so few tasks too.
        df = df.repartition(partitions)
    elif rows_per_file >= FILE_ROWS:
        pass
    elif by is not None:
        df = df.hint("rebalance", by)
    elif even:
        df = df.hint("rebalance")
    writer = df.write.mode(mode).option("header", True)
    if compression is not None:
        writer = writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    if by is None:
        writer.csv(path)
        return
    # Else each task sorts its rows by folder, on disk if they are many.
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, _OPEN_FILES)
    try:
        writer.partitionBy(by).csv(path)
    finally:
        conf.set(name, before)


def create_csv(df: DataFrame, path: str, *, partitions: int | None = None) -> None:
    """As ``write_csv``, but an existing path is an error."""
    write_csv(df, path, mode="errorifexists", partitions=partitions)


def new_run(root: str) -> str:
    """A new folder below ``root`` for the files of one load."""
    return f"{root.rstrip('/')}/run-{uuid.uuid4().hex}"


def commit_run(spark: SparkSession, root: str, run: str) -> None:
    """Make the files of ``run`` the ones that count: a small record names the folder once all are written."""
    commits = f"{root.rstrip('/')}/commits"
    while True:
        taken = records.names(spark, commits)
        if records.create(spark, f"{commits}/{int(taken[-1]) + 1 if taken else 1:020d}", {"run": run}):
            return


def committed_run(spark: SparkSession, root: str) -> str | None:
    """The folder with the files of the last load that has ended; never one that is being written."""
    commits = f"{root.rstrip('/')}/commits"
    taken = records.names(spark, commits)
    return records.read(spark, f"{commits}/{taken[-1]}")["run"] if taken else None
