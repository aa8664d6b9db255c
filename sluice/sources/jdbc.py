"""Database tables through Spark's JDBC source. Connection options come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    table: str,
    options: Mapping[str, str],
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 10,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """A table or bracketed query; with a partition column it is read in parallel ranges."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    df = reader.load()
    return df.orderBy(*order_by) if order_by else df
