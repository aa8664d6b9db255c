"""Reference lists: extracts that are built once, and the filters they are built with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.functions.stamp import timestamp
from sluice.operators.rules import all_present
from sluice.scratch import materialize
from sluice.sinks.store import Store


def cached_extract(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The Parquet extract at ``path``; if it is not there as a whole, ``build`` and write it first.

    Whole is an extract with the marker that a finished write leaves. What a broken-off write or the
    loss of the marker left behind is replaced.
    """
    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        build().write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def younger_than(column: str, days: int, as_of: datetime) -> Column:
    """Less than ``days`` days before ``as_of``, which is an argument so that a run can be repeated."""
    return F.col(column) > timestamp(as_of) - F.make_dt_interval(F.lit(days))


def key_extract(df: DataFrame, key: str, name: str, condition: Column) -> DataFrame:
    """Key column as text under ``name``, of the rows that meet ``condition``."""
    return df.filter(condition).select(F.col(key).cast("string").alias(name))


def refresh_extract(
    store: Store, name: str, source: DataFrame, key: str, changed: str, *, days: int, as_of: datetime, keep: Column | None = None
) -> DataFrame:
    """Bring an extract of a store up to date and return it: rows of ``source`` that meet ``keep`` and were changed
    (column ``changed``, a time without zone) less than ``days`` days before ``as_of``.

    The extract holds the columns of ``source``, whose keys are unique. From ``source`` only rows changed since
    the last refresh are read; they take the place of the rows with their keys, or these go if they no longer
    qualify. Rows that have grown too old are taken out. Only files with such rows are written again. How far
    the source was read is committed together with the rows, so a refresh that breaks off is done again. Changes
    must not be stamped before the last refresh. Rows without a key or time are left out.
    """
    young, columns = younger_than(changed, days, as_of), source.columns
    load = store.begin()
    load.create(name, source.schema, [key])
    rows = source.filter(all_present([key, changed]) & (F.col(changed) <= timestamp(as_of)))
    mark = load.mark(name)
    if mark is None:
        load.append(name, rows.filter(young if keep is None else young & keep))
    else:
        since = rows.filter(F.col(changed) > timestamp(datetime.fromisoformat(mark)))
        since = materialize(since.select(*columns, (young if keep is None else young & keep).alias("__stays")), "changed-rows")
        load.delete(name, ~young)
        load.merge(name, since, lambda part: part.join(since.select(key), key, "left_anti").select(*columns).unionAll(since.filter("__stays").select(*columns)))
    load.set_mark(name, as_of.isoformat())
    load.commit()
    return store.read(name)
