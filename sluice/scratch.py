"""Intermediate tables, written once to the shared folder of the cluster.

A written table cuts the lineage, is read back column by column, and is still there when the
executor that wrote it is lost.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a folder of
    one machine cannot be read by the others, so the setting is required there.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/sluice-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="sluice-")
    return _own_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, arrow_rows: int | None = None, *, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the scratch folder and return the written table.

    ``arrow_rows`` bounds the rows that a Python worker gets at a time, for long rows; ``codec`` compresses
    the table otherwise than the session does.
    """
    path = scratch_path(df.sparkSession, label)
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, arrow_rows or before)
    try:
        df.write.parquet(path, compression=codec)
    finally:
        conf.set(name, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; frames that were derived from them are void.

    For the end of a load whose results stand in their targets.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
