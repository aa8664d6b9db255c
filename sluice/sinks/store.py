"""Tables as sets of files, several of which change with one commit.

A table is a list of logs; a log says which data files it adds (with their rows, bytes, least and greatest
key, a bitmap of key hashes of fixed size, and the tag they were written under) and which it takes away. A
transaction writes data files and logs that no one knows of, and then creates one small record that names
the logs of all tables. Readers take the last record, so they see all changes of a load or none, and a load
that breaks off leaves nothing but unused files. Records are numbered and created once: of two loads at the
same time the second finds its number taken; if they changed the same table it is refused, else it goes on
behind the other.

A merge reads and rewrites only the files that can hold one of its keys: their range of keys has one, and a
bit of the bitmap is set for it. All others are carried over by name. Changes can also be put beside the base
(``log_changes``) and be merged when the table is read, until ``compact`` puts them into the files they hit.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sluice.operators.lookups import fits_broadcast
from sluice.operators.rules import all_present, any_null
from sluice.operators.upsert import delete_where, upsert
from sluice.scratch import materialize
from sluice.sinks import records

BITS = 32768  # bits of the bitmap of a file
LOGS = 40  # logs of a table from which its live files are written as one


class Conflict(RuntimeError):
    """Another load has changed a table that this one changes."""


def _position(keys: Sequence[str]):
    return F.pmod(F.xxhash64(*keys), F.lit(BITS)).cast("int")


class Store:
    """The tables below ``root``, a folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.ids = records.Claims(spark, f"{self.root}/ids")

    def _last(self) -> tuple[int, dict]:
        commits = records.names(self.spark, f"{self.root}/commits")
        return (int(commits[-1]), records.read(self.spark, f"{self.root}/commits/{commits[-1]}")["tables"]) if commits else (0, {})

    def begin(self) -> Transaction:
        return Transaction(self)

    def exists(self, table: str) -> bool:
        return self.begin().exists(table)

    def read(self, table: str, tags: Sequence[str] | None = None) -> DataFrame:
        """The table after the last commit; with ``tags`` only the files written under them are read."""
        return self.begin().read(table, tags)


class Transaction:
    """Reads see the last commit before it began and its own changes; ``commit`` makes these visible, all at once."""

    def __init__(self, store: Store) -> None:
        self.store, self.spark = store, store.spark
        self.number, self.tables = store._last()
        self.before = dict(self.tables)
        self.steps = 0
        #: Changed tables; those that were only appended to with the logs that did so.
        self.appended: dict[str, list[str] | None] = {}

    # --- reading ---

    def exists(self, table: str) -> bool:
        return table in self.tables

    def schema(self, table: str) -> T.StructType:
        return T.StructType.fromJson(self.tables[table]["schema"])

    def _log_schema(self, table: str) -> T.StructType:
        keys = self.tables[table]["keys"]
        key = self.schema(table)[keys[0]].dataType if keys else T.LongType()
        fields = [("file", T.StringType()), ("op", T.StringType()), ("kind", T.StringType()), ("tag", T.StringType()), ("sequence", T.LongType()),
                  ("rows", T.LongType()), ("bytes", T.LongType()), ("least", key), ("greatest", key), ("bitmap", T.BinaryType())]
        return T.StructType([T.StructField(*f) for f in fields])

    def files(self, table: str) -> DataFrame:
        """The live data files of a table."""
        paths = [f"{self.store.root}/{table}/log/{n}" for n in self.tables[table]["logs"]]
        if not paths:
            return self.spark.createDataFrame([], self._log_schema(table))
        logs = self.spark.read.schema(self._log_schema(table)).parquet(*paths)
        gone = logs.filter("op = 'remove'").select("file")
        return logs.filter("op = 'add'").join(gone, "file", "left_anti")

    def _rows(self, table: str, paths: list[str]) -> DataFrame:
        # Any scan lists its files on the driver.
        schema = self.schema(table)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, table: str, tags: Sequence[str] | None = None) -> DataFrame:
        """All rows, changes beside the base included; with ``tags`` only those of files written under them."""
        files = self.files(table)
        if tags is not None:
            files = files.filter(F.col("tag").isin(list(tags)))
        found = [(r.file, r.kind, r.sequence) for r in files.select("file", "kind", "sequence").collect()]
        base = self._rows(table, [f for f, kind, _ in found if kind == "base"])
        changes = [(f, n) for f, kind, n in found if kind == "change"]
        return self._with_changes(table, base, changes) if changes else base

    def _changes(self, table: str, files: list[tuple[str, int]]) -> DataFrame:
        """One row a changed key: what the first change inserts, under what the last one sets."""
        spec = self.tables[table]
        keys, updates = spec["keys"], spec["updates"]
        rows = None
        for number in sorted({n for _, n in files}):
            part = self._rows(table, [f for f, n in files if n == number]).withColumn("__sequence", F.lit(number))
            rows = part if rows is None else rows.unionAll(part)
        row = F.struct(*[c for c in rows.columns if c != "__sequence"])
        ends = rows.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(
            F.min_by(row, "__sequence").alias("first"), F.max_by(row, "__sequence").alias("last")
        )
        return ends.select(*[F.col(f"{'last' if c in updates else 'first'}.{c}").alias(c) for c in self.schema(table).names])

    def _with_changes(self, table: str, base: DataFrame, files: list[tuple[str, int]]) -> DataFrame:
        spec = self.tables[table]
        return upsert(base, self._changes(table, files), spec["keys"], spec["updates"])

    # --- writing ---

    def create(self, table: str, schema: T.StructType, keys: Sequence[str] = (), updates: Sequence[str] | None = None) -> None:
        """Make ``table`` known. ``keys`` are indexed; ``updates`` are the columns that logged changes set."""
        if table not in self.tables:
            columns = [c for c in schema.names if c not in keys] if updates is None else list(updates)
            self.tables[table] = {"schema": schema.jsonValue(), "keys": list(keys), "updates": columns, "logs": []}

    def mark(self, table: str):
        """What ``set_mark`` has last put beside the table."""
        return self.tables.get(table, {}).get("mark")

    def set_mark(self, table: str, mark) -> None:
        """Put a value of JSON, such as how far a source was read, beside the table; it is committed with its rows."""
        self.tables = {**self.tables, table: {**self.tables[table], "mark": mark}}
        self.appended[table] = None

    def _write(self, table: str, df: DataFrame, kind: str, tag: str | None) -> DataFrame:
        """New data files, as rows of a log."""
        schema, keys = self.schema(table), self.tables[table]["keys"]
        known = set(df.columns)
        whole = df.select(*[(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        folder = f"{self.store.root}/{table}/data/{uuid.uuid4().hex}"
        whole.write.parquet(folder)
        held = [f"key {n}" for n in range(len(keys))]
        rows = self.spark.read.schema(schema).parquet(folder).select(
            *[F.col(k).alias(h) for k, h in zip(keys, held)], F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
        )
        first = F.col(held[0]) if keys else F.lit(None).cast("long")
        # Bit positions count from the number 1.
        bitmap = F.bitmap_construct_agg(F.bitmap_bit_position(_position(held).cast("long") + 1)) if keys else F.first(F.lit(None).cast("binary"))
        self.steps += 1
        stats = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes"), F.min(first).alias("least"), F.max(first).alias("greatest"), bitmap.alias("bitmap"))
        facts = {"op": F.lit("add"), "kind": F.lit(kind), "tag": F.lit(tag).cast("string"), "sequence": F.lit((self.number + 1 << 20) + self.steps).cast("long")}
        names = self._log_schema(table).names
        return stats.withColumns(facts).select(*names)

    def _log(self, table: str, entries: DataFrame, *, whole: bool = False, append: bool = False) -> None:
        name = uuid.uuid4().hex
        entries.write.parquet(f"{self.store.root}/{table}/log/{name}")
        logs = [name] if whole else [*self.tables[table]["logs"], name]
        self.tables = {**self.tables, table: {**self.tables[table], "logs": logs}}
        earlier = self.appended.get(table, [])
        self.appended[table] = [*earlier, name] if append and earlier is not None else None
        if len(logs) > LOGS:
            self._log(table, self.files(table), whole=True)

    def _gone(self, files: DataFrame) -> DataFrame:
        return files.withColumn("op", F.lit("remove")).withColumn("bitmap", F.lit(None).cast("binary"))

    def append(self, table: str, df: DataFrame, tag: str | None = None) -> None:
        """Add rows; columns that ``df`` lacks are null, those that the table lacks are left out."""
        self._log(table, self._write(table, df, "base", tag), append=True)

    def overwrite(self, table: str, df: DataFrame, tag: str | None = None) -> None:
        """Put ``df``, which may be derived from the table, in place of all rows."""
        self._log(table, self._write(table, df, "base", tag), whole=True)

    def replace_tag(self, table: str, df: DataFrame, tag: str) -> None:
        """Put ``df``, which may be empty, in place of the rows written under ``tag``; no file of others is read."""
        old = self._gone(self.files(table).filter(F.col("tag") == tag))
        self._log(table, old.unionByName(self._write(table, df, "base", tag)))

    def drop_tags(self, table: str, tags: Sequence[str]) -> None:
        """Take out what was written under ``tags``; no data file is read or written."""
        self._log(table, self._gone(self.files(table).filter(F.col("tag").isin(list(tags)))))

    def hit_files(self, table: str, source: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        """The live files that can hold a key of ``source`` (its columns ``names``, else named as the keys).

        Few keys are sent to the log rows, which look them up by bisection; with many, the range of all of
        them has to do. Files whose keys are all null hold none.
        """
        keys, schema = self.tables[table]["keys"], self.schema(table)
        typed = source.select(*[F.col(n).cast(schema[k].dataType).alias(k) for k, n in zip(keys, names or keys)]).filter(all_present(keys))
        files = self.files(table)
        if not fits_broadcast(typed):
            low, high = typed.agg(F.min(keys[0]), F.max(keys[0])).first()
            return files.filter((F.col("greatest") >= F.lit(low)) & (F.col("least") <= F.lit(high)))
        found = sorted({(r[0], r[1]) for r in typed.select(keys[0], _position(keys)).distinct().collect()}, key=lambda r: r[0])
        shared = self.spark.sparkContext.broadcast(([k for k, _ in found], np.array([p for _, p in found], np.int64)))
        at = {n: k for k, n in enumerate(files.columns)}

        def run(batches):
            held, places = shared.value
            for batch in batches:
                keep = []
                for low, high, bitmap in zip(*(batch.column(at[c]).to_pylist() for c in ("least", "greatest", "bitmap"))):
                    inside = slice(bisect_left(held, low), bisect_right(held, high)) if low is not None else slice(0, 0)
                    bits = np.unpackbits(np.frombuffer(bitmap or b"", np.uint8), bitorder="little")
                    keep.append(bool(bits[places[inside]].any()))
                yield batch.filter(pa.array(keep, pa.bool_()))

        return files.mapInArrow(run, files.schema)

    def merge(self, table: str, source: DataFrame, rewrite: Callable[[DataFrame], DataFrame], names: Sequence[str] | None = None) -> int:
        """Rewrite the files that can hold a key of ``source``; returns how many that are.

        ``rewrite`` gets their rows and returns those that stand there afterwards, new ones included. It may
        change rows with keys of ``source`` only. Changes beside the base are put into it first.
        """
        if not self.files(table).filter("kind = 'change'").isEmpty():
            self.compact(table)
        hit = materialize(self.hit_files(table, source, names), "hit-files")
        paths = [r.file for r in hit.select("file").collect()]
        entries = self._write(table, rewrite(self._rows(table, paths)), "base", None)
        self._log(table, self._gone(hit).unionByName(entries))
        return len(paths)

    def delete(self, table: str, condition: Column) -> int:
        """Take out the rows for which ``condition`` is true; returns how many files that touches.

        Of all files only the columns of the condition are read; those with such a row are written again.
        """
        if not self.files(table).filter("kind = 'change'").isEmpty():
            self.compact(table)
        files = self.files(table)
        paths = [r.file for r in files.select("file").collect()]
        found = self._rows(table, paths).filter(condition).select(F.col("_metadata.file_path").alias("file")).distinct() if paths else files.limit(0)
        hit = materialize(files.join(found.select("file"), "file", "left_semi"), "hit-files")
        # A tag stays with what is left of its files.
        tags = [r.tag for r in hit.select("tag").distinct().collect()]
        touched, entries = 0, self._gone(hit)
        for tag in tags:
            own = [r.file for r in hit.filter(F.col("tag").eqNullSafe(F.lit(tag))).select("file").collect()]
            touched += len(own)
            entries = entries.unionByName(self._write(table, delete_where(self._rows(table, own), condition), "base", tag))
        if touched:
            self._log(table, entries)
        return touched

    def log_changes(self, table: str, df: DataFrame) -> None:
        """Put changed and new rows beside the base; a later change of a key counts more. A key stands once in ``df``."""
        keys = self.tables[table]["keys"]
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(all_present(keys))
        if not counts.filter("__n > 1").isEmpty():
            raise ValueError(f"the changes hold a key more than once: {', '.join(keys)}")
        # Rows without a key change none.
        self._log(table, self._write(table, df.filter(any_null(keys)), "base", None).unionByName(self._write(table, df.filter(all_present(keys)), "change", None)))

    def compact(self, table: str) -> int:
        """Put the changes beside the base into the files that they hit; returns how many those are."""
        files = self.files(table)
        changes = [(r.file, r.sequence) for r in files.filter("kind = 'change'").select("file", "sequence").collect()]
        if not changes:
            return 0
        self._log(table, self._gone(files.filter("kind = 'change'")))
        source, spec = self._changes(table, changes), self.tables[table]
        return self.merge(table, source, lambda rows: upsert(rows, source, spec["keys"], spec["updates"]))

    def commit(self) -> int:
        """Make the changes visible; returns the number of the commit."""
        while True:
            if records.create(self.spark, f"{self.store.root}/commits/{self.number + 1:020d}", {"tables": self.tables}):
                self.number, self.before, self.appended = self.number + 1, dict(self.tables), {}
                return self.number
            number, others = self.store._last()
            for table, added in self.appended.items():
                if others.get(table) != self.before.get(table):
                    same = {k: v for k, v in self.tables[table].items() if k != "logs"}
                    if added is None or any(others.get(table, {}).get(k) != v for k, v in same.items()):
                        raise Conflict(f"{table} was changed by another load")
                    others = {**others, table: {**others[table], "logs": [*others[table]["logs"], *added]}}
                else:
                    others = {**others, table: self.tables[table]}
            self.number, self.tables = number, {**self.tables, **others}
