"""Catalog tables, replaced as a whole or by partition.

A table cannot be overwritten while it is read, and a load that breaks off must leave the old
rows. So ``publish`` writes a new table and then points a view of the public name to it. Where
a load touches few partitions of a large table, ``touched`` and ``overwrite_partitions`` read
and write only those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluice.operators.lookups import fits_broadcast
from sluice.scratch import materialize


_VERSION, _BUCKET_BY, _BUCKETS = "sluice.version", "sluice.bucketBy", "sluice.buckets"


def _versions(spark: SparkSession, name: str) -> list[int]:
    database, _, short = name.rpartition(".")
    prefix = f"{short}__v".lower()
    names = [
        t.name.lower()
        for t in spark.catalog.listTables(database or spark.catalog.currentDatabase())
        if not t.isTemporary
    ]
    return sorted(
        int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit()
    )


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def _live(spark: SparkSession, name: str) -> tuple[int, list[str], int]:
    """Version that the public name stands for, and its bucketing."""
    facts = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    version = int(facts.get(_VERSION) or max(_versions(spark, name), default=0))
    columns = facts.get(_BUCKET_BY, "")
    return version, columns.split(",") if columns else [], int(facts.get(_BUCKETS, 0))


def _writer(df: DataFrame, mode: str, bucket_by: Sequence[str], buckets: int):
    writer = df.write.format("parquet").mode(mode)
    if bucket_by:
        # One task per bucket, else every task would write a file into every bucket.
        placed = df.repartition(buckets, *bucket_by)
        writer = placed.write.format("parquet").mode(mode).bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    return writer


def publish(
    df: DataFrame, name: str, *, bucket_by: Sequence[str] = (), buckets: int = 0
) -> DataFrame:
    """Write ``df`` as the next version of ``name`` and switch to it.

    A table bucketed by its key is joined to a large source without a shuffle of the table; a name that
    is bucketed stays so. A plain table of that name keeps its place: its rows are replaced by a stored
    copy of ``df``, which is still there if that breaks off.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists and not _is_view(spark, name):
        rows = materialize(df.select(*spark.table(name).columns), "table-rows")
        rows.write.insertInto(name, overwrite=True)
        return spark.table(name)
    if exists and not bucket_by:
        _, bucket_by, buckets = _live(spark, name)
    version = max(_versions(spark, name), default=0) + 1
    _writer(df, "errorifexists", bucket_by, buckets).saveAsTable(f"{name}__v{version}")
    layout = f", '{_BUCKET_BY}' = '{','.join(bucket_by)}', '{_BUCKETS}' = '{buckets}'" if bucket_by else ""
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_VERSION}' = '{version}'{layout}) "
        f"AS SELECT * FROM {name}__v{version}"
    )
    return spark.table(name)


def current(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The published table, or an empty one before the first load."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def drop_old_versions(spark: SparkSession, name: str, keep: int = 2) -> None:
    """Keep the live version and the ``keep`` - 1 before it; versions that were never switched to go too."""
    live = _live(spark, name)[0] if _is_view(spark, name) else 0
    before = [v for v in _versions(spark, name) if v < live]
    kept = {live, *before[len(before) - (keep - 1):]} if keep > 1 else {live}
    for version in _versions(spark, name):
        if version not in kept:
            spark.sql(f"DROP TABLE {name}__v{version}")


def clear(spark: SparkSession, name: str) -> None:
    """Take all rows out of a table; a published name gets an empty version."""
    if _is_view(spark, name):
        publish(spark.table(name).filter("false"), name)
    else:
        spark.sql(f"TRUNCATE TABLE {name}")


def append(df: DataFrame, name: str) -> None:
    """Append to a table, or to the version that a published name stands for; matched by name."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").saveAsTable(name)
    elif _is_view(spark, name):
        version, bucket_by, buckets = _live(spark, name)
        _writer(df, "append", bucket_by, buckets).saveAsTable(f"{name}__v{version}")
    else:
        df.select(*spark.table(name).columns).write.insertInto(name)


def replace_batch(df: DataFrame, name: str, column: str, value) -> None:
    """Put the rows of ``df``, all with ``value`` in ``column``, in place of those with that value.

    The table is partitioned by ``column``: other batches are neither read nor written. Without rows the
    partition is dropped.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").partitionBy(column).saveAsTable(name)
    elif df.isEmpty():
        drop_batches(spark, name, column, [value])
    else:
        overwrite_partitions(df, name)


def drop_batches(spark: SparkSession, name: str, column: str, values: Sequence) -> None:
    """Take out the partitions with ``values`` in ``column`` through the catalog; no data file is read."""
    for value in values:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = {value!r})")


def touched(
    target: DataFrame, source: DataFrame, on: Sequence[tuple[str, str]], partition: str, source_partition: str
) -> DataFrame:
    """The rows of ``target`` in partitions that a load of ``source`` can change.

    These are the partitions that hold a row with one of its keys (``on``: target, source) and
    those that its own rows belong to. An update must not move rows to another partition.
    ``source`` is read twice: store it first.
    """
    data_type = target.schema[partition].dataType
    wanted = source.select(*[F.col(s).cast(target.schema[t].dataType).alias(t) for t, s in on])
    if fits_broadcast(wanted):
        wanted = F.broadcast(wanted)
    held = target.join(wanted, [t for t, _ in on], "left_semi").select(F.col(partition).alias("p"))
    own = source.select(F.col(source_partition).cast(data_type).alias("p"))
    # A list of partitions: the driver lists them to plan any scan of the table.
    values = [r.p for r in held.union(own).distinct().collect()]
    column = F.col(partition)
    inside = column.isin([v for v in values if v is not None])
    return target.filter(inside | column.isNull() if None in values else inside)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that ``df`` has rows for; the other partitions are not written.

    The partitions are swapped one after the other, from a stored copy of ``df`` (it may be derived from
    the table). A load that breaks off in between is completed by writing that copy again: it stays below
    the scratch folder until that is cleared.
    """
    spark = df.sparkSession
    df = materialize(df.select(*spark.table(table).columns), "partition-rows")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    # A table may be read while its partitions are replaced only if the session says so.
    spark.conf.set(mode, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
