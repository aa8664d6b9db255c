"""The batch jobs. Each reads files and tables, writes files and tables, and returns counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from sluice import schemas
from sluice.functions.stamp import audit, new_batch_id, rename, surrogate_id
from sluice.operators.changes import deal_performance, dedup, dropped_duplicates, flag_changes
from sluice.operators.lookups import ReferenceList, fits_broadcast, flag_known, left_join_unique
from sluice.operators.numbering import number_records, renumber
from sluice.operators.rules import Broken, Required, classify
from sluice.operators.upsert import delete_where, has_known_key, upsert
from sluice.plans import leads
from sluice.scratch import materialize
from sluice.sinks.files import commit_run, new_run, write_csv
from sluice.sinks.store import Store
from sluice.sinks.tables import append, clear, current, drop_batches, publish, replace_batch
from sluice.sources.extracts import path_exists
from sluice.sources.delimited import (
    physical_lines, read_delimited, scan_delimited, store_delimited,
)


#: Of the tables that a validated load keeps of all rows; they take about 0.6 of the usual space.
CODEC = "zstd"


@dataclass
class IntakeResult:
    """Counts of a load and the stored frames behind them."""

    counts: dict[str, int]
    frames: dict[str, DataFrame] = field(default_factory=dict)


@dataclass(frozen=True)
class LeadTables:
    """Names of the three lead targets and, for staged loads, of the rows kept by batch.

    With ``store`` they are tables of that store: a load changes all of them with one commit, rewrites only
    the files that hold a lead it changes, and claims its ids, so that other loads can run at the same time.
    Else they are tables of the catalog, switched one after the other.
    """

    leads: str
    members: str
    items: str
    staging: str | None = None
    errors: str | None = None
    store: Store | None = None


class _Targets:
    """The tables of one load, in the catalog or in a transaction of a store."""

    KEYS = {"leads": ["LEAD_ID"], "members": ["MKL_LEAD_TC_MEMBER_ID"], "items": ["PROD_ASSOC_ID"]}

    def __init__(self, spark: SparkSession, names: LeadTables) -> None:
        self.spark, self.names = spark, names
        self.open = names.store.begin() if names.store else None

    def _keys(self, name: str) -> list[str]:
        return next((k for table, k in self.KEYS.items() if getattr(self.names, table) == name), [])

    def exists(self, name: str | None) -> bool:
        return bool(name) and (self.open.exists(name) if self.open else self.spark.catalog.tableExists(name))

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        if not self.open:
            return current(self.spark, name, schema)
        return self.open.read(name) if self.open.exists(name) else self.spark.createDataFrame([], schema)

    def columns(self, name: str) -> list[str]:
        return self.open.schema(name).names if self.open else self.spark.table(name).columns

    def batch(self, name: str, batch_id: int) -> DataFrame:
        """The rows of a batch; no file of another batch is read."""
        rows = self.open.read(name, [str(batch_id)]) if self.open else self.spark.table(name)
        return rows.filter(F.col("BATCH_ID") == batch_id)

    def replace_batch(self, name: str, rows: DataFrame, batch_id: int) -> None:
        if self.open:
            self.open.create(name, rows.schema, self._keys(name))
            self.open.replace_tag(name, rows, str(batch_id))
        else:
            replace_batch(rows, name, "BATCH_ID", batch_id)

    def add_to_batch(self, name: str, rows: DataFrame, schema: T.StructType, batch_id: int) -> None:
        """Add rows of a batch to those that it has."""
        if self.open:
            self.open.append(name, rows, str(batch_id))
        else:
            append(_whole(rows, T.StructType([*schema.fields, T.StructField("BATCH_ID", T.IntegerType())])), name)

    def append(self, name: str, rows: DataFrame, schema: T.StructType) -> None:
        if self.open:
            self.open.create(name, schema, self._keys(name))
            self.open.append(name, rows)
        else:
            append(_whole(rows, schema), name)

    def merge(self, name: str, schema: T.StructType, keys: DataFrame, rewrite) -> None:
        """Put ``rewrite`` of the rows that can have one of ``keys`` (columns named as the table's) in their place."""
        if self.open:
            self.open.create(name, schema, self._keys(name))
            self.open.merge(name, keys, rewrite)
        else:
            publish(rewrite(current(self.spark, name, schema)), name)

    def commit(self) -> None:
        if self.open:
            self.open.commit()


def intake_reasons(rows: DataFrame, parties: ReferenceList, products: ReferenceList) -> DataFrame:
    """Add ``reject_reason``: malformed, the reason of a reject, or null for a row that passes."""
    return classify(rows, [
        Broken(F.col(schemas.CORRUPT).isNotNull(), "malformed"),
        *leads.intake_rules(parties, products),
    ])


def split_outcomes(judged: DataFrame, existing: ReferenceList, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``judged`` that pass and those set apart, with ``outcome`` in place of ``reject_reason``.

    Only rows that pass are looked up in a large list; those set apart stay where they are. The look-up reads
    lead numbers from ``stored``, the table behind ``judged``.
    """
    passes = F.col("reject_reason").isNull()
    passed = judged.filter(passes).drop("reject_reason")
    apart = judged.filter(~passes).withColumnRenamed("reject_reason", "outcome")
    return flag_changes(passed, "leadNumber", existing, "outcome", stored=stored.filter(passes)), apart


def intake_outcomes(
    rows: DataFrame, parties: ReferenceList, products: ReferenceList, existing: ReferenceList
) -> DataFrame:
    """Add ``outcome``: malformed, the reason of a reject, 'update' or 'insert'."""
    judged, reason = intake_reasons(rows, parties, products), F.col("reject_reason")
    if existing.in_place(rows.schema["leadNumber"].dataType):
        judged = flag_changes(judged, "leadNumber", existing)
        return judged.withColumn("outcome", F.coalesce(reason, "change")).drop("reject_reason", "change")
    judged = materialize(judged, "judged", codec=CODEC)
    passed, apart = split_outcomes(judged, existing, judged)
    return passed.unionByName(apart)


def _stored_outcomes(
    rows: DataFrame, parties: ReferenceList, products: ReferenceList, existing: ReferenceList
) -> tuple[DataFrame, dict[str, int], int]:
    """The rows with ``outcome`` and ``FILE_RECORD_NUM``, stored, their counts, and the tasks that read them.

    Sorted by outcome inside each file, so that a later step for one class skips the pages of the others;
    folders per class would make one more file per task and class. With a large list of leads, only rows
    that pass are written once more after the look-up; the others are read from the table of the first pass.
    """
    outcome, reason, number = F.col("outcome"), F.col("reject_reason"), "FILE_RECORD_NUM"
    performance = deal_performance("BudgetAmount", "dealSize")
    apart = ["malformed", *(r.reason for r in leads.intake_rules(parties, products))]
    signs = {"outperformed": performance > 0, "met": performance == 0, "underperformed": performance < 0}
    changes = {**{c: outcome == c for c in ("update", "insert")}, **{n: (outcome == "insert") & c for n, c in signs.items()}}
    if existing.in_place(rows.schema["leadNumber"].dataType):
        judged = intake_outcomes(rows, parties, products, existing).sortWithinPartitions("outcome")
        judged, seen = _observed(judged, {**{c: outcome == c for c in apart}, **changes, "records": F.lit(True)})
        judged = materialize(judged, "outcomes", codec=CODEC)
        stored, found = number_records(judged, number), seen.get
    else:
        judged = intake_reasons(rows, parties, products).sortWithinPartitions("reject_reason")
        judged, seen = _observed(judged, {**{c: reason == c for c in apart}, "records": F.lit(True)})
        judged = materialize(judged, "judged", codec=CODEC)
        # Numbered first: the look-up needs not carry the places in the file.
        passed, rest = split_outcomes(number_records(judged, number), existing, judged)
        passed, changed = _observed(passed.sortWithinPartitions("outcome"), changes)
        passed = materialize(passed, "outcomes", codec=CODEC)
        stored = passed.unionByName(rest).select(*[c for c in rest.columns if c not in ("outcome", number)], "outcome", number)
        found = {**seen.get, **changed.get}
    return stored, {n: v for n, v in found.items() if v or n in signs}, judged.rdd.getNumPartitions()


def validated_intake(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    parties: ReferenceList,
    products: ReferenceList,
    existing: ReferenceList,
    *,
    targets: LeadTables | None = None,
    at: datetime | str,
    by: str,
    files: int | None = None,
    count_lines: bool = False,
    runs: bool = False,
    compression: str | None = "gzip",
) -> IntakeResult:
    """Load a lead file: reject, split, remove repeats, fan out, upsert.

    Updates are counted and returned, not applied. Writes ``format_errors``, ``rejects`` and
    ``success/*`` below ``output_path`` and, with ``targets``, the three tables. ``count_lines``
    reads the file once more to count its physical lines. With ``runs`` the files of every load stand in a
    folder of their own, which ``committed_run(spark, output_path)`` names when the load has ended. Files are
    written with ``compression``, plain if that is None.
    """
    root, output_path = output_path, new_run(output_path) if runs else output_path
    tables = _Targets(spark, targets) if targets is not None else None
    rows = scan_delimited(spark, input_path, schemas.LEAD_FILE)
    checks = [("customerId", parties), ("primaryContactId", parties), ("productGroupId", products)]
    if not all(ref.in_place(schemas.LEAD_FILE[column].dataType) for column, ref in checks):
        # Large references are looked up from the rows more than once; do not parse again for that.
        rows = materialize(rows, "scanned", codec=CODEC)
    # The checks run once.
    stored, counts, tasks = _stored_outcomes(rows, parties, products, existing)
    records = counts.pop("records", 0)
    outcome, performance = F.col("outcome"), deal_performance("BudgetAmount", "dealSize")
    is_malformed = outcome == "malformed"
    write_csv(
        _readable(stored.filter(is_malformed).drop("outcome")),
        f"{output_path}/format_errors", partitions=files, even=True, rows_per_file=counts.get("malformed", 0) / max(1, tasks),
        compression=compression,
    )
    reasons = [counts[r.reason] for r in leads.intake_rules(parties, products) if r.reason in counts]
    kept = outcome.isin("update", "insert")
    write_csv(
        stored.filter(~is_malformed & ~kept).drop(schemas.CORRUPT).withColumnRenamed("outcome", "reject_reason"),
        f"{output_path}/rejects", partitions=files, by="reject_reason", compression=compression,
        rows_per_file=sum(reasons) / max(1, tasks * len(reasons)),
    )

    inserts = (
        stored.filter(outcome == "insert")
        .drop(schemas.CORRUPT, "outcome")
        .withColumn("DealPerformance", performance)
    )
    first, kept_rows = _observed(dedup(inserts, ["leadNumber"], ["FILE_RECORD_NUM"]), {"inserted": F.lit(True)})
    first = materialize(first, "first-leads", codec=CODEC)
    repeats = dropped_duplicates(inserts, first, ["leadNumber"], ["FILE_RECORD_NUM"])
    counts.update(kept_rows.get)
    counts["duplicates"] = counts.get("insert", 0) - counts["inserted"]
    if count_lines:
        counts["physical_lines"] = physical_lines(spark, input_path)

    frames = {
        "outcomes": stored,
        "updates": stored.filter(outcome == "update").drop(schemas.CORRUPT, "outcome"),
        "duplicates": repeats,
    }
    if counts["inserted"]:
        start = _free_leads(tables, records) if tables else 0
        # Record numbers are unique in the file, so ids above the highest in use need no counting.
        fresh = first.withColumn("LEAD_ID", F.col("FILE_RECORD_NUM") + F.lit(start))
        frames["leads"] = leads.standardise_leads(fresh, at, by)
        frames["members"] = leads.standardise_members(fresh, at, by)
        frames["items"] = leads.standardise_items(fresh, at, by)
        for name in ("leads", "members", "items"):
            write_csv(frames[name], f"{output_path}/success/{name}", partitions=files, compression=compression)
        if tables:
            # Leads last: children above the highest lead are those of a load that broke off.
            for name, schema, updates, rows in (
                ("members", schemas.LEAD_MEMBERS, schemas.MEMBER_UPDATES, frames["members"]),
                ("items", schemas.LEAD_ITEMS, schemas.ITEM_UPDATES, frames["items"]),
                ("leads", schemas.LEADS, schemas.LEAD_UPDATES, frames["leads"].select(*schemas.LEAD_INSERTS)),
            ):
                if tables.open:
                    # The ids are claimed: none is in use.
                    tables.append(getattr(targets, name), rows, schema)
                else:
                    _load(spark, getattr(targets, name), schema, rows, _Targets.KEYS[name], updates)
            tables.commit()
    if runs:
        commit_run(spark, root, output_path)
    return IntakeResult(counts, frames)


def _observed(rows: DataFrame, conditions: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``rows`` with counts of the rows that meet each condition, taken while they are written.

    For a frame that is written as it is: its last stage counts every task once, however often one runs.
    """
    seen = Observation()
    return rows.observe(seen, *[F.count_if(c).alias(n) for n, c in conditions.items()]), seen


def _free_leads(tables: _Targets, records: int) -> int:
    """A number above which ``records`` lead ids are free; children that stand above it are taken out."""
    names = tables.names
    highest = lambda: tables.read(names.leads, schemas.LEADS).agg(F.max("LEAD_ID")).first()[0] or 0
    if tables.open:
        return names.store.ids.claim("LEAD_ID", records, first=lambda: highest() + 1) - 1
    top = highest()
    for name in (names.members, names.items):
        _drop_orphans(tables.spark, name, top)
    return top


def _drop_orphans(spark: SparkSession, table: str, top: int) -> None:
    """Take out the children of leads above ``top``, which a load that broke off has left."""
    if spark.catalog.tableExists(table):
        rows = spark.table(table)
        if not rows.filter(F.col("LEAD_ID") > top).isEmpty():
            publish(delete_where(rows, F.col("LEAD_ID") > top), table)


def _readable(rows: DataFrame) -> DataFrame:
    """Spark's CSV reader would fill a column of the old name itself."""
    return rows.withColumnRenamed(schemas.CORRUPT, "malformed_line")


def _whole(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with the columns of ``schema``; those that they lack are null."""
    known = set(rows.columns)
    return rows.select(
        *[(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def _load(spark, table, schema, rows, keys, update_columns) -> None:
    """Keyed upsert into a published table; without a known key that is an append."""
    if not spark.catalog.tableExists(table):
        publish(_whole(rows, schema), table)
        return
    target = spark.table(table)
    if has_known_key(target, rows, keys):
        publish(upsert(target, rows, keys, update_columns), table)
    else:
        append(_whole(rows, schema), table)


def staged_intake(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    parties: ReferenceList,
    products: ReferenceList | None,
    targets: LeadTables,
    *,
    at: datetime | str,
    by: str,
    batch_id: int | None = None,
    replace: bool = False,
    files: int | None = None,
    count_lines: bool = False,
) -> IntakeResult:
    """Load a lead file through staging rows with a status code, an error log and reports.

    With ``products`` the file has the wide layout and gives member and item rows; without, it has the
    narrow layout and only leads are merged. A lead number that the target knows keeps its id (the lowest,
    if several have it) and is updated; a file that names such a lead twice is refused. Other rows get ids
    above the highest in use, and so do members and items.

    The reports must not exist and the batch id must be new. ``replace`` loads a batch again, after a
    load that broke off or to correct it (with ``targets.staging``). Its rows are known by their content, the
    lead number and its how-manieth occurrence in the file, and keep the ids they had, wherever they stand in
    the new file. Leads that this batch alone has inserted are put in anew, and those that the new file lacks
    or that fail now are taken out; a lead that another batch has updated since stays. Members, items, staging
    rows and errors of the batch are replaced, by nothing if there are none now.
    """
    wide = products is not None
    layout = schemas.LEAD_FILE_WIDE if wide else schemas.LEAD_FILE_NARROW
    tables = _Targets(spark, targets)
    batch_id = _batch_id(tables, batch_id, replace, at)
    reports = [f"{output_path}/status", *([f"{output_path}/errors"] if wide else [])]
    if not replace and (taken := [r for r in reports if path_exists(spark, r)]):
        raise ValueError(f"exists already: {', '.join(taken)}")
    rules = [
        Broken(F.col(schemas.CORRUPT).isNotNull(), "malformed"),
        Required(leads.REQUIRED if wide else leads.REQUIRED_NARROW, "missing_required"),
    ]
    if wide:
        rules.append(Required(["productGroupId"], "missing_product_group"))
    # Judged and counted in the pass that stores the parsed rows.
    bad = F.col("reject_reason")
    judged, seen = _observed(
        classify(scan_delimited(spark, input_path, layout), rules), {**{f"rejected_{r.reason}": bad == r.reason for r in rules}, "records": F.lit(True)}
    )
    rows = number_records(materialize(judged, "scanned"), "FILE_RECORD_NUM")
    write_csv(
        _readable(rows.filter(bad == "malformed").drop("reject_reason")),
        f"{output_path}/format_errors", partitions=files, even=True,
    )
    write_csv(
        rows.filter(bad != "malformed").drop(schemas.CORRUPT),
        f"{output_path}/rejects", partitions=files, by="reject_reason",
    )

    target = tables.read(targets.leads, schemas.LEADS)
    earlier = tables.batch(targets.staging, batch_id) if replace and tables.exists(targets.staging) else None
    own = None
    if earlier is not None:
        earlier = materialize(earlier, "earlier-batch")
        own = _inserted_alone(tables, earlier, batch_id)
        target = target.join(own, "LEAD_ID", "left_anti")
    known = _with_lead_ids(tables, rows.filter(bad.isNull()), target, earlier, own, seen.get["records"])
    staged = leads.stage_rows(known, layout, batch_id, at, by, key="lead_id")
    status = leads.import_status(
        staged, batch_id, leads.staged_rules(parties, products), ReferenceList(target, "LEAD_ID")
    )
    code, updated = F.col("IMPORT_STATUS_CODE"), F.col("IMPORT_MODE").isNotNull()
    status, judgement = _observed(status, {"I": code == "I", "E": code == "E", "updates": (code == "I") & updated})
    status = materialize(status, "import-status")
    found = dict(judgement.get)
    if targets.staging and not tables.open:
        # Before the targets: a load that breaks off finds its ids here, and the leads that it was to take out.
        kept = status
        if own is not None:
            gone = own.join(status.filter(code == "I").select(F.col("PK1").alias("LEAD_ID")), "LEAD_ID", "left_anti")
            kept = status.unionByName(earlier.join(gone, F.col("PK1") == F.col("LEAD_ID"), "left_semi"))
        tables.replace_batch(targets.staging, kept, batch_id)
    frames = {"status": leads.finished(status)}
    if not found["updates"] and own is None and tables.exists(targets.leads):
        tables.append(targets.leads, leads.inserted_leads(status, target.schema), schemas.LEADS)
    else:
        touched = status.filter(code == "I").select(F.col("PK1").alias("LEAD_ID"))

        def rewrite(part: DataFrame) -> DataFrame:
            return leads.merge_leads(part if own is None else part.join(own, "LEAD_ID", "left_anti").select(*part.columns), status)

        tables.merge(targets.leads, schemas.LEADS, touched if own is None else touched.unionAll(own), rewrite)
    if wide:
        accepted = materialize(leads.accepted_rows(status), "accepted")
        for name, table, schema, build in (
            ("members", targets.members, schemas.LEAD_MEMBERS, leads.member_rows),
            ("items", targets.items, schemas.LEAD_ITEMS, leads.item_rows),
        ):
            frames[name] = build(accepted, _child_base(tables, table, _Targets.KEYS[name][0], batch_id, found["I"]))
            by_batch = T.StructType([*schema.fields, T.StructField("BATCH_ID", T.IntegerType())])
            children = _whole(frames[name].withColumn("BATCH_ID", F.lit(batch_id)), by_batch)
            if tables.exists(table) and "BATCH_ID" not in tables.columns(table):
                if replace:
                    raise ValueError(f"{table} does not keep batches apart")
                tables.append(table, children.drop("BATCH_ID"), schema)
            else:
                tables.replace_batch(table, children, batch_id)
        frames["errors"] = leads.error_log(status)
        if targets.errors:
            tables.replace_batch(targets.errors, frames["errors"], batch_id)
    if targets.staging:
        tables.replace_batch(targets.staging, frames["status"], batch_id)
    tables.commit()
    mode = "overwrite" if replace else "errorifexists"
    if wide:
        write_csv(leads.error_report(frames["errors"]), f"{output_path}/errors", mode=mode, partitions=files)
    write_csv(leads.status_report(frames["status"]), f"{output_path}/status", mode=mode, partitions=files)

    counts = {n: v for n, v in seen.get.items() if v and n != "records"}
    counts.update({c: n for c, n in (("S", found["I"]), ("E", found["E"])) if n})
    counts["batch_id"] = batch_id
    if count_lines:
        counts["physical_lines"] = physical_lines(spark, input_path)
    return IntakeResult(counts, frames)


def _batch_id(tables: _Targets, batch_id: int | None, replace: bool, at: datetime | str) -> int:
    """A batch id that is not in use; with a store it is taken, so that no other load can get it too."""
    if tables.open:
        free = lambda n: tables.names.store.ids.take("batches", n, at=str(at))
    else:
        free = lambda n: not _batch_in_use(tables.spark, tables.names, n)
    if batch_id is None:
        batch_id = new_batch_id()
        while not free(batch_id):
            batch_id = new_batch_id()
    elif not free(batch_id) and not replace:
        raise ValueError(f"batch {batch_id} is in use")
    return batch_id


def _batch_in_use(spark: SparkSession, targets: LeadTables, batch_id: int) -> bool:
    names = [n for n in (targets.staging, targets.errors, targets.members, targets.items) if n and spark.catalog.tableExists(n)]
    kept = [spark.table(n) for n in names if "BATCH_ID" in spark.table(n).columns]
    return any(not t.filter(F.col("BATCH_ID") == batch_id).isEmpty() for t in kept)


def _inserted_alone(tables: _Targets, earlier: DataFrame, batch_id: int) -> DataFrame:
    """LEAD_ID of the leads that the batch has inserted and no other batch has updated since."""
    taken = F.col("IMPORT_STATUS_CODE").isin("I", "S")
    inserted = earlier.filter(taken & F.col("IMPORT_MODE").isNull()).select(F.col("PK1").alias("LEAD_ID"))
    others = tables.read(tables.names.staging, earlier.schema).filter(taken & (F.col("BATCH_ID") != batch_id)).select(F.col("PK1").alias("LEAD_ID"))
    return materialize(inserted.join(others, "LEAD_ID", "left_anti").distinct(), "own-leads")


def _with_lead_ids(
    tables: _Targets, rows: DataFrame, target: DataFrame, earlier: DataFrame | None, own: DataFrame | None, records: int
) -> DataFrame:
    """Add ``lead_id``: that of the same row of a batch that is replaced, else of the lead number, else a new one.

    ``target`` is without the leads that the batch alone has inserted (``own``).
    """
    names = tables.names
    if tables.open:
        highest = lambda: (target.agg(F.max("LEAD_ID")).first()[0] or 0) + 1
        top = names.store.ids.claim("LEAD_ID", max(1, records), first=highest) - 1
    else:
        top = tables.read(names.leads, schemas.LEADS).agg(F.max("LEAD_ID")).first()[0] or 0
        if tables.exists(names.staging):
            top = max(top, tables.spark.table(names.staging).agg(F.max("PK1")).first()[0] or 0)
    number = next(c for c in rows.columns if c.lower() == "leadnumber")  # the layouts differ in case
    wanted = rows.select(F.col(number).cast("string").alias("LEAD_NUMBER")).distinct()
    held = target.select("LEAD_NUMBER", "LEAD_ID")
    if fits_broadcast(wanted):
        held = held.join(F.broadcast(wanted), "LEAD_NUMBER", "left_semi")
    ids = materialize(held.groupBy("LEAD_NUMBER").agg(F.min("LEAD_ID").alias("known_id")), "known-leads")
    found = left_join_unique(rows, ids.withColumnRenamed("LEAD_NUMBER", "known_number"), [(number, "known_number")])
    columns = [F.col("known_id"), F.col("FILE_RECORD_NUM") + F.lit(top)]
    if earlier is not None:
        before = renumber(earlier.select("FILE_RECORD_NUM", F.col(leads.LEAD_NUMBER).alias("number"), F.col("PK1").alias("earlier_id")), "FILE_RECORD_NUM", "occurrence", within=["number"])
        before = materialize(left_join_unique(before, own.select(F.col("LEAD_ID").alias("own_id"), F.lit(True).alias("own")), [("earlier_id", "own_id")]), "earlier-rows")
        found = renumber(materialize(found, "numbered-leads"), "FILE_RECORD_NUM", "place", within=[number])
        found = left_join_unique(found, before.drop("FILE_RECORD_NUM"), [(number, "number"), ("place", "occurrence")])
        # A row that was not inserted, or not by this batch alone, has to give way to a lead of its number.
        columns = [F.when(F.col("own"), F.col("earlier_id")), columns[0], F.col("earlier_id"), columns[1]]
    return found.withColumn("lead_id", F.coalesce(*columns).cast("long"))


def _child_base(tables: _Targets, table: str, key: str, batch_id: int, count: int) -> int:
    """A number above which ``count`` child ids are free; a batch that is loaded again gets those that it had."""
    highest = lambda: _highest_child(tables, table, key, batch_id)
    if tables.open:
        return tables.names.store.ids.claim(key, max(1, count), owner=f"batch {batch_id}", first=lambda: highest() + 1) - 1
    return highest()


def _highest_child(tables: _Targets, table: str, key: str, batch_id: int) -> int:
    """Highest child id in use, without those that the batch wrote before."""
    if not tables.exists(table):
        return leads.CHILD_BASE
    rows = tables.read(table, T.StructType())
    if "BATCH_ID" in rows.columns:
        rows = rows.filter(~F.col("BATCH_ID").eqNullSafe(F.lit(batch_id)))
    return max(leads.CHILD_BASE, rows.agg(F.max(F.col(key).try_cast("long"))).first()[0] or 0)


def clean_lead_tables(spark: SparkSession, targets: LeadTables, *, children: bool = True) -> None:
    """Delete the leads that have a country and, with ``children``, all member and item rows.

    Never part of a load: it would leave nothing to update.
    """
    tables, gone = _Targets(spark, targets), F.col("COUNTRY").isNotNull()
    if tables.exists(targets.leads):
        left = delete_where(tables.read(targets.leads, schemas.LEADS), gone)
        if tables.open:
            tables.open.overwrite(targets.leads, left)
        else:
            publish(left, targets.leads)
    for name in (targets.members, targets.items) if children else ():
        if tables.exists(name):
            if tables.open:
                tables.open.overwrite(name, tables.open.read(name).filter("false"))
            else:
                clear(spark, name)
    tables.commit()


def changed_keys(old: ReferenceList, new: ReferenceList) -> tuple[DataFrame, bool]:
    """Keys (``__ref``, as text) that only one of the lists has, and whether the verdict of every row can change.

    That is so if only one of them is empty or holds a null, since ``NOT IN`` is true for no row then.
    """
    before, after = (r.keys(T.StringType()) for r in (old, new))
    facts = [(r.frame.filter(F.col(r.key).isNull()).isEmpty(), r.frame.isEmpty()) for r in (old, new)]
    only = before.join(after, "__ref", "left_anti").unionAll(after.join(before, "__ref", "left_anti")).filter("__ref IS NOT NULL")
    return materialize(only, "changed-keys"), facts[0] != facts[1]


def revalidate_batches(
    spark: SparkSession,
    targets: LeadTables,
    old: tuple[ReferenceList, ReferenceList],
    new: tuple[ReferenceList, ReferenceList],
) -> dict[str, int]:
    """Judge the kept rows of all batches again after the lists (parties, products) have changed.

    Only rows with a key that a list has gained or lost are judged; the staging rows of batches without such a
    row are not read but for their keys. A row in error that is valid now is loaded: its lead is merged and
    gets its children. A loaded row that has become invalid gets the status and an entry in the errors; its
    lead stays. Returns the rows judged, loaded and turned to errors.
    """
    tables, columns = _Targets(spark, targets), [(leads.PRODUCT, 1), (leads.CUSTOMER, 0), (leads.CONTACT, 0)]
    changed = [changed_keys(o, n) for o, n in zip(old, new)]
    staging = tables.read(targets.staging, T.StructType())
    keys = staging.select("BATCH_ID", "FILE_RECORD_NUM", *[c for c, _ in columns])
    if any(every for _, every in changed):
        hits = keys
    else:
        hits = None
        for column, which in columns:
            found = keys.join(changed[which][0].withColumnRenamed("__ref", column), column, "left_semi")
            hits = found if hits is None else hits.unionByName(found)
    hits = materialize(hits.select("BATCH_ID", "FILE_RECORD_NUM").distinct(), "rows-to-judge")
    result = {"judged": hits.count(), "loaded": 0, "errors": 0}
    # The driver lists the batches to plan the scan of them.
    for batch_id in sorted(r.BATCH_ID for r in hits.select("BATCH_ID").distinct().collect()):
        kept = materialize(tables.batch(targets.staging, batch_id), "kept-batch")
        own = hits.filter(F.col("BATCH_ID") == batch_id).select("FILE_RECORD_NUM")
        judged = classify(kept.join(own, "FILE_RECORD_NUM", "left_semi").drop("ERROR_MESSAGE"), leads.staged_rules(*new), "ERROR_MESSAGE")
        before = kept.select("FILE_RECORD_NUM", F.col("IMPORT_STATUS_CODE").alias("before"))
        judged = judged.join(before, "FILE_RECORD_NUM").withColumn("IMPORT_STATUS_CODE", F.when(F.col("ERROR_MESSAGE").isNotNull(), "E").when(F.col("before") == "E", "I").otherwise("S"))
        code = F.col("IMPORT_STATUS_CODE")
        judged, seen = _observed(judged, {"loaded": code == "I", "errors": (code == "E") & (F.col("before") != "E"), "any": F.lit(True)})
        judged = materialize(judged, "judged-again")
        fresh = judged.filter(code == "I")
        for name in ("loaded", "errors"):
            result[name] += seen.get[name]
        if seen.get["loaded"]:
            known = tables.read(targets.leads, schemas.LEADS)
            marked = flag_known(fresh.drop("IMPORT_MODE"), "PK1", ReferenceList(known, "LEAD_ID"), "known", null_safe=False, stored=judged)
            fresh = materialize(marked.withColumn("IMPORT_MODE", F.when(F.col("known"), "U")).select(*kept.columns), "loaded-again")
            tables.merge(targets.leads, schemas.LEADS, fresh.select(F.col("PK1").alias("LEAD_ID")), lambda part, rows=fresh: leads.merge_leads(part, rows))
            accepted = materialize(leads.accepted_rows(fresh), "accepted-again")
            for table, schema, build in ((targets.members, schemas.LEAD_MEMBERS, leads.member_rows), (targets.items, schemas.LEAD_ITEMS, leads.item_rows)):
                key = next(k for n, k in _Targets.KEYS.items() if getattr(targets, n) == table)[0]
                if tables.open:
                    base = targets.store.ids.claim(key, seen.get["loaded"], first=lambda: _highest_child(tables, table, key, -1) + 1) - 1
                else:
                    base = _highest_child(tables, table, key, -1)
                children = build(accepted, base).withColumn("BATCH_ID", F.lit(batch_id).cast("int"))
                tables.add_to_batch(table, children, schema, batch_id)
        rest = kept.join(own, "FILE_RECORD_NUM", "left_anti").select(*kept.columns)
        turned = judged.filter(code != "I").select(*kept.columns)
        whole = materialize(leads.finished(rest.unionAll(turned).unionAll(fresh.select(*kept.columns) if seen.get["loaded"] else turned.filter("false"))), "judged-batch")
        tables.replace_batch(targets.staging, whole, batch_id)
        if targets.errors:
            tables.replace_batch(targets.errors, leads.error_log(whole), batch_id)
    tables.commit()
    return result


def retire_batches(spark: SparkSession, targets: LeadTables, batch_ids: Sequence[int]) -> None:
    """Take the staging rows and errors of old batches out; leads and their children stay.

    Only partitions or file names are dropped: no data file is read or written. A retired batch can no longer
    be corrected.
    """
    tables = _Targets(spark, targets)
    for name in filter(tables.exists, (targets.staging, targets.errors)):
        if tables.open:
            tables.open.drop_tags(name, [str(b) for b in batch_ids])
        else:
            drop_batches(spark, name, "BATCH_ID", batch_ids)
    tables.commit()


def batches_before(targets: LeadTables, at: datetime | str) -> list[int]:
    """The batches of a store that were loaded before a time, told by their records alone.

    ``at`` and the times of the loads are times, or text of one form whose order is that of time.
    """
    return sorted(n for n, facts in targets.store.ids.taken("batches").items() if facts["at"] < str(at))


def direct_upsert(
    spark: SparkSession,
    input_path: str,
    table: str,
    schema: T.StructType,
    keys: Sequence[str],
    update_columns: Sequence[str],
    insert_columns: Sequence[str] | None = None,
    store: Store | None = None,
) -> DataFrame:
    """Upsert a header CSV file into a table; of rows with one key the last in the file counts.

    With ``store`` it is a table of that store, of which only the files are rewritten that can hold a key of
    the file.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in _header(spark, input_path)])
    rows = store_delimited(spark, input_path, text)
    columns = insert_columns or [c for c in rows.columns if c in schema.fieldNames()]
    change = lambda part: upsert(part, rows, keys, update_columns, columns, ["FILE_RECORD_NUM"])
    if store is None:
        return publish(change(current(spark, table, schema)), table)
    load = store.begin()
    load.create(table, schema, keys, update_columns)
    load.merge(table, rows, change)
    load.commit()
    return store.read(table)


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def reference_rows(
    rows: DataFrame,
    renames: dict[str, str],
    *,
    at: datetime | str,
    by: str,
    id_column: str | None = None,
    id_start: int = 0,
) -> DataFrame:
    """Rows for a reference table: renamed, stamped and, with ``id_column``, given unique ids."""
    renamed = rename(rows, renames)
    if id_column is not None:
        renamed = surrogate_id(renamed, id_column, id_start)
    return audit(renamed, at, by)


def reference_upload(
    spark: SparkSession, input_path: str, table: str, renames: dict[str, str], *, store: Store | None = None, **stamps
) -> DataFrame:
    """Append a header CSV file to a table, or to one of ``store``, as ``reference_rows``."""
    rows = reference_rows(read_delimited(spark, input_path), renames, **stamps)
    if store is None:
        append(rows, table)
        return spark.table(table)
    load = store.begin()
    load.create(table, rows.schema)
    load.append(table, rows)
    load.commit()
    return store.read(table)
