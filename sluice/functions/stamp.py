"""Columns that a load adds: audit, batch and id stamps, and renames."""

from __future__ import annotations

import random
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from sluice.operators.numbering import dense_number

# Fixed value: pattern of audit times carried as text, e.g. 01-JAN-06 12.00.00.000000000 AM.
AUDIT_TEXT = "dd-MMM-yy hh.mm.ss.SSSSSSSSS a"


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Only the columns in ``names`` (input -> target), under their target names."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def parse_audit_text(column: Column) -> Column:
    return F.to_timestamp_ntz(column, F.lit(AUDIT_TEXT))


def timestamp(at: datetime) -> Column:
    """Literal of a time without zone; passed as text, so that no time zone has a say."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def audit(df: DataFrame, at: datetime | str, by: str) -> DataFrame:
    """Add the four audit columns; ``at`` is a time or its text form."""
    when = parse_audit_text(F.lit(at)) if isinstance(at, str) else timestamp(at)
    return df.withColumns(
        {
            "CREATION_DATE": when,
            "LAST_UPDATE_DATE": when,
            "CREATED_BY": F.lit(by),
            "LAST_UPDATED_BY": F.lit(by),
        }
    )


def new_batch_id() -> int:
    return random.randrange(1_000_000)


def batch(df: DataFrame, batch_id: int) -> DataFrame:
    return df.withColumn("BATCH_ID", F.lit(batch_id).cast("int"))


def surrogate_id(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Unique, not dense. Store the frame before it is used twice: the ids belong to one run."""
    return df.withColumn(name, F.monotonically_increasing_id() + F.lit(start))


def padded(number: Column, width: int = 11) -> Column:
    """Text with zeros in front up to ``width``; a longer number keeps all its digits."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def sequence_id(
    df: DataFrame, order_by: list[str], name: str, base: int = 0, width: int = 11, cheap: bool = False
) -> DataFrame:
    """Dense zero-padded id: base+1, base+2, ... in ``order_by`` order; ``cheap`` as in ``dense_number``."""
    numbered = dense_number(df, order_by, "__number", start=base + 1, cheap=cheap)
    return numbered.withColumn(name, padded(F.col("__number"), width)).drop("__number")


def as_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns as strings, null kept."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns or df.columns})
