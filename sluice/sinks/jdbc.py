"""Append to database tables through Spark's JDBC writer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def append_table(
    df: DataFrame, table: str, options: Mapping[str, str], *, partitions: int = 10, batch_size: int = 1000
) -> None:
    """Append ``df``; columns are matched by name, rows go in batches over ``partitions`` connections."""
    (
        df.write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("numPartitions", partitions)
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )
