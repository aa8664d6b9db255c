"""Required-field and referential rules; each row gets the reason of the first rule it breaks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from sluice.operators.lookups import ReferenceList, flag_known, flag_not_in


@dataclass(frozen=True)
class Broken:
    """Rows for which ``condition`` holds."""

    condition: Column
    reason: str


@dataclass(frozen=True)
class Required:
    """Rows in which any of ``columns`` is null."""

    columns: Sequence[str]
    reason: str


@dataclass(frozen=True)
class Unknown:
    """Rows whose ``column`` is not in ``reference``.

    Null matches null, or with ``sql_not_in`` the three-valued NOT IN decides.
    """

    column: str
    reference: ReferenceList
    reason: str
    sql_not_in: bool = False


Rule = Broken | Required | Unknown


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def classify(df: DataFrame, rules: Sequence[Rule], reason: str = "reject_reason") -> DataFrame:
    """Add ``reason``: that of the first broken rule in the given order, null if none is broken.

    All rules are decided in one pass over the rows, in place of a pair of joins per rule.
    """
    columns, stored = df.columns, df
    broken = []
    flags: dict[tuple, str] = {}
    for rule in rules:
        if isinstance(rule, Broken):
            failed = rule.condition
        elif isinstance(rule, Required):
            failed = any_null(rule.columns)
        else:
            check = (rule.column, id(rule.reference), rule.sql_not_in)
            if check not in flags:
                flags[check] = f"__rule_{len(flags)}"
                mark = flag_not_in if rule.sql_not_in else flag_known
                df = mark(df, rule.column, rule.reference, flags[check], stored=stored, bits_first=True)
            failed = F.col(flags[check]) if rule.sql_not_in else ~F.col(flags[check])
        broken.append(F.when(failed, F.lit(rule.reason)))
    return df.select(*columns, F.coalesce(*broken).alias(reason))


def accepted(classified: DataFrame, reason: str = "reject_reason") -> DataFrame:
    return classified.filter(F.col(reason).isNull()).drop(reason)


def rejected(classified: DataFrame, reason: str = "reject_reason") -> DataFrame:
    return classified.filter(F.col(reason).isNotNull())


def union_rejects(frames: Sequence[DataFrame]) -> DataFrame:
    """One frame of rejects from frames of different width; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
