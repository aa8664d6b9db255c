"""Dense row numbers without collecting the rows in one task.

A row's number is its position in its part of the data plus the number of rows in the parts before.
Only one line per part is needed for that; the rows themselves stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sluice.operators.lookups import left_join_unique
from sluice.scratch import materialize, scratch_path

RANGE_ROWS = 1_000_000


def with_place(df: DataFrame) -> DataFrame:
    """Add where each scanned row lies: its file, the block of the file, and a rising number.

    ``df`` must be a file scan. The rows of one block are read by one task one after the other,
    so their rising numbers have no gaps.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("__source"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__line"),
    )


def number_records(stored: DataFrame, name: str, *, start: int = 1) -> DataFrame:
    """Replace the columns of ``with_place`` by ``name``, the number of the row in file order.

    ``stored`` must be a written table that holds every scanned row. One line per block gives
    the rows before it; the rows are neither shuffled nor sorted.
    """
    block = ["__source", "__block"]
    # One task sums the counts, a line per block: about a million for 100 TB.
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        stored.groupBy(*block)
        .agg(F.count(F.lit(1)).alias("__rows"), F.min("__line").alias("__first"))
        .select(
            *block,
            (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__offset"),
        ),
        "block-offsets",
    )
    numbered = left_join_unique(stored, offsets, [(c, c) for c in block])
    number = (F.lit(start) + F.col("__offset") + F.col("__line")).cast("long")
    return numbered.withColumn(name, number).drop(*block, "__line", "__offset")


def renumber(
    df: DataFrame, number: str, name: str, *, start: int = 1, within: Sequence[str] = ()
) -> DataFrame:
    """Add ``name``: start, start+1, ... in the order of ``number``, anew per ``within`` group.

    ``number`` is a unique integer without large gaps, such as the record number of rows of which
    some were filtered out. Ranges of it bound what one task sorts, whatever the groups hold, and
    no pass over the rows is needed to find the ranges. ``df`` is read twice: store it first.
    """
    row_range = F.col(number) - F.pmod(F.col(number), F.lit(RANGE_ROWS))
    # As one struct, a group with a null in it equals itself in the join too.
    rows = df.withColumns({"__range": row_range, "__group": F.struct(F.lit(0), *within)})
    keys = ["__group", "__range"]
    before = (
        Window.partitionBy("__group").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(*keys, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    )
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(number))
    # The join hashes on the keys of the window, so the rows are shuffled once.
    numbered = rows.withColumn("__place", place).join(offsets, keys)
    value = (F.lit(start - 1) + F.col("__offset") + F.col("__place")).cast("long")
    return numbered.withColumn(name, value).select(*df.columns, name)


def dense_number(
    df: DataFrame, order_by: Sequence[str], name: str, *, start: int = 1, within: Sequence[str] = (), cheap: bool = False
) -> DataFrame:
    """Add ``name``: start, start+1, ... in ``order_by`` order, anew for each ``within`` group.

    ``order_by`` must be a total order (within the group). The range partitioning cuts inside a
    group too, so a group of any size is spread. Finding the ranges is a pass of its own, so the rows are
    stored before; ``cheap`` says that they are read or made again at little cost, and saves that.
    """
    group = list(within)
    order = [*group, *[c for c in order_by if c not in group]]
    if not cheap:
        df = materialize(df, "unordered")
    path = scratch_path(df.sparkSession, "ordered")
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    stored = (
        df.sparkSession.read.schema(df.schema)
        .parquet(path)
        .select(
            "*",
            F.col("_metadata.file_name").alias("__file"),
            F.col("_metadata.row_index").alias("__position"),
        )
    )
    keys = [*group, "__file"]
    # Written files are named after the task: part-<task number>-... Without groups one task sums
    # the counts, a line per file.
    task = F.regexp_extract("__file", r"part-(\d+)", 1).cast("long")
    before = (
        Window.partitionBy(*group).orderBy(task, "__file").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = materialize(
        stored.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"), F.min("__position").alias("__first"))
        .select(
            *keys,
            (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__offset"),
        ),
        "file-offsets",
    )
    numbered = left_join_unique(stored, offsets, [(k, k) for k in keys], null_safe=True)
    number = (F.lit(start) + F.col("__offset") + F.col("__position")).cast("long")
    return numbered.withColumn(name, number).drop("__file", "__position", "__offset")
