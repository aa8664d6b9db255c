"""Change detection against existing keys, removal of repeated keys, deal figures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from sluice.operators.lookups import ReferenceList, flag_known
from sluice.scratch import materialize


def flag_changes(
    df: DataFrame,
    key: str,
    existing: ReferenceList,
    change: str = "change",
    *,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Add ``change``: 'update' when the key exists already, else 'insert'.

    A large list is looked up in several readings of the rows: of ``stored``, or of ``df``, which is stored first.
    """
    if stored is None and not existing.in_place(df.schema[key].dataType):
        df = stored = materialize(df, "rows-to-compare")
    marked = flag_known(df, key, existing, "__exists", stored=stored, bits_first=True)
    return marked.withColumn(change, F.when(F.col("__exists"), "update").otherwise("insert")).drop(
        "__exists"
    )


def dedup(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: str = "first"
) -> DataFrame:
    """One row per key: the first (or last) by ``order_by``, nulls lowest.

    An aggregate, not a window: every task reduces its rows to one per key before the shuffle,
    so a key with any number of copies arrives as one row per task.
    """
    pick = F.min_by if keep == "first" else F.max_by
    row = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(*[F.col(c) for c in order_by])
    return df.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(
        pick(row, order).alias("__row")
    ).select("__row.*")


def dropped_duplicates(
    df: DataFrame, survivors: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Rows of ``df`` that ``dedup`` did not keep; of ``survivors`` only the identity is read.

    ``keys`` and ``order_by`` together identify a row. The anti join hashes on all of them, so
    the copies of one key spread over all tasks.
    """
    identity = list(dict.fromkeys([*keys, *order_by]))
    kept = survivors.select(*[F.col(c).alias(f"__kept_{c}") for c in identity])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__kept_{c}")) for c in identity])
    return df.join(kept, same, "left_anti")


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``."""
    return left.subtract(right)


def deal_performance(budget: str, deal: str) -> Column:
    """Budget minus deal size as a long, null if either is null."""
    return F.col(budget).cast("long") - F.col(deal).cast("long")


def deal_buckets(df: DataFrame, performance: str) -> DataFrame:
    """One row: leads above, at and below budget; a null difference is in none."""
    value = F.col(performance)
    return df.agg(
        F.count_if(value > 0).alias("outperformed"),
        F.count_if(value == 0).alias("met"),
        F.count_if(value < 0).alias("underperformed"),
    )


def deal_totals(df: DataFrame, deal: str, budget: str) -> DataFrame:
    return df.agg(
        F.sum(F.col(deal).cast("long")).alias("total_deal_size"),
        F.sum(F.col(budget).cast("long")).alias("total_budget"),
    )


def class_counts(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Rows per class in one aggregation."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count))
