"""Keyed upsert, conditional merge and delete as set operations that give the new table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from sluice.operators.changes import dedup
from sluice.operators.lookups import fits_broadcast, left_join_unique
from sluice.operators.rules import all_present, any_null
from sluice.scratch import materialize


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    insert_columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """``target`` after each row of ``source`` updated the row with its key, or was inserted.

    Columns not in ``update_columns`` keep their value, columns not in ``insert_columns`` (all
    source columns by default) are null on insert. Of source rows with one key the last by
    ``order_by`` counts; without ``order_by`` a repeated key is an error. A null key never
    matches, so such rows are inserted.
    """
    inserted = [c for c in (insert_columns or source.columns) if c in target.columns]
    if order_by:
        last = dedup(source.filter(all_present(keys)), keys, order_by, keep="last")
        source = last.unionByName(source.filter(any_null(keys)))
    rows = materialize(source, "upsert-source")
    if not order_by:
        _check_unique(rows, keys)
    return _apply(
        target, rows, rows, [(k, k) for k in keys],
        {c: F.col(c) for c in update_columns}, {c: F.col(c) for c in inserted},
    )


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[tuple[str, str]],
    update_set: Mapping[str, str],
    insert_values: Mapping[str, str],
    matched_when: Column,
    insert_when: Column,
) -> DataFrame:
    """``target`` after a conditional merge.

    ``on`` pairs target and source keys. A matched target row gets ``update_set`` (target column
    -> source column) where ``matched_when`` holds; an unmatched source row is inserted with
    ``insert_values`` where ``insert_when`` holds. Everything else stays. Two source rows that
    update one key are an error. ``source`` is read several times: store it first.
    """
    updates = source.filter(matched_when)
    _check_unique(updates, [s for _, s in on])
    return _apply(
        target, updates, source.filter(insert_when), on,
        {t: F.col(s) for t, s in update_set.items()}, {t: F.col(s) for t, s in insert_values.items()},
    )


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """``target`` without the rows for which ``condition`` is true; null keeps a row, as in SQL."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def _check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    counts = df.filter(all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    if not counts.filter("__n > 1").isEmpty():
        raise ValueError(f"the source holds a key more than once: {', '.join(keys)}")


def _apply(target, updates, inserts, on, set_columns, insert_columns) -> DataFrame:
    types = {f.name: f.dataType for f in target.schema}
    names = target.columns
    incoming = updates.select(
        *[F.col(s).alias(f"__on_{s}") for _, s in on],
        *[value.cast(types[c]).alias(f"__new_{c}") for c, value in set_columns.items()],
        F.lit(True).alias("__hit"),
    ).filter(all_present([f"__on_{s}" for _, s in on]))
    changed = left_join_unique(target, incoming, [(t, f"__on_{s}") for t, s in on]).select(
        *[
            F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            if c in set_columns
            else F.col(c)
            for c in names
        ]
    )
    fresh = _unmatched(inserts, target, on).select(
        *[
            (insert_columns[c] if c in insert_columns else F.lit(None)).cast(types[c]).alias(c)
            for c in names
        ]
    )
    return changed.unionByName(fresh)


def has_known_key(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key of ``rows`` is in ``target``; of both only the keys are read."""
    return not _present(target, rows, [(k, k) for k in keys]).isEmpty()


def _typed_keys(rows: DataFrame, target: DataFrame, on) -> dict[str, Column]:
    return {s: F.col(s).cast(target.schema[t].dataType) for t, s in on}


def _present(target: DataFrame, rows: DataFrame, on) -> DataFrame:
    """Keys of ``target`` that ``rows`` has too, as ``__t_<key>``.

    A broadcast of the keys of ``rows`` reduces the keys of ``target`` in place when their
    measured size allows; the target is then not shuffled at all.
    """
    held = target.select(*[F.col(t).alias(f"__t_{s}") for t, s in on])
    wanted = rows.select(*[v.alias(f"__w_{s}") for s, v in _typed_keys(rows, target, on).items()])
    same = reduce(and_, [F.col(f"__t_{s}") == F.col(f"__w_{s}") for _, s in on])
    if fits_broadcast(wanted):
        return held.join(F.broadcast(wanted), same, "left_semi").distinct()
    return held.distinct().join(wanted, same, "left_semi")


def _unmatched(rows: DataFrame, target: DataFrame, on) -> DataFrame:
    """Rows of ``rows`` whose key is not in ``target``."""
    typed = _typed_keys(rows, target, on)
    same = reduce(and_, [value == F.col(f"__t_{s}") for s, value in typed.items()])
    # Rows without a key match nothing; set apart, they do not meet in one task of the join.
    keyed = reduce(and_, [value.isNotNull() for value in typed.values()])
    missing = rows.filter(keyed).join(_present(target, rows.filter(keyed), on), same, "left_anti")
    return missing.unionAll(rows.filter(~keyed))
