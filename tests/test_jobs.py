import glob
import uuid
from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sluice import schemas
from sluice.operators.lookups import ReferenceList
from sluice.plans import jobs, leads as L
from sluice.sinks.files import committed_run
from sluice.sinks.store import Conflict, Store
from sluice.sinks.tables import publish
from sluice.sources.delimited import read_delimited

AT = "01-JAN-06 12.00.00.000000000 AM"


def tables():
    tag = uuid.uuid4().hex[:8]
    return jobs.LeadTables(f"leads_{tag}", f"members_{tag}", f"items_{tag}")


def references(spark):
    parties = spark.createDataFrame([(i,) for i in range(1, 20)], "party_id long")
    products = spark.createDataFrame([(5, "US"), (5, "DE"), (6, "US")], "prod_group_id long, language string")
    existing = spark.createDataFrame([("L1",), ("L1",)], "lead_number string")
    return ReferenceList(parties, "party_id"), ReferenceList(products, "prod_group_id"), ReferenceList(existing, "lead_number")


# number, customer, contact, name, deal, city, state, country, usage, role, product, currency, budget
FILE_A = [
    "L1,1,2,update,5,C,S,US,U,R,5,USD,9",
    "L2,1,2,first,5,C,S,US,U,R,5,USD,9",
    "L2,3,2,second,9,C,S,US,U,R,6,USD,9",
    'L3,1,2,"quoted, comma",9,"C, x",S,,U,R,5,USD,1',
    "L4,77,2,customer,5,C,S,US,U,R,5,USD,9",
    "L5,1,77,contact,5,C,S,US,U,R,5,USD,9",
    "L6,1,2,product,5,C,S,US,U,R,77,USD,9",
    "L7,77,77,both,5,C,S,US,U,R,77,USD,9",
    ",1,2,no number,5,C,S,US,U,R,5,USD,9",
    "L8,1,2,no product,5,C,S,US,U,R,,USD,9",
    "L9,1,2,bad deal,xx,C,S,US,U,R,5,USD,9",
    "L10,1,2,short",
    "L11,1,2,no figures,,C,S,US,U,R,5,USD,",
]


def lead_file(folder, layout, lines):
    header = ",".join(f for f in layout.fieldNames() if f != schemas.CORRUPT)
    path = f"{folder}/in.csv"
    with open(path, "w") as out:
        out.write("\n".join([header, *lines]) + "\n")
    return path


@pytest.mark.parametrize("large", [False, True])
def test_validated_intake(spark, conf, folder, large):
    if large:
        conf("sluice.broadcastBytes", "-1")
        conf("sluice.hotRows", "1")
    # Several blocks in the small file.
    conf("spark.sql.files.maxPartitionBytes", "150")
    conf("spark.sql.files.openCostInBytes", "10")
    parties, products, existing = references(spark)
    targets = tables()
    old = spark.createDataFrame([(40, "L0")], "LEAD_ID long, LEAD_NUMBER string")
    publish(old.select(*[
        (F.col(f.name) if f.name in old.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.LEADS
    ]), targets.leads)
    path = lead_file(folder, schemas.LEAD_FILE, FILE_A)
    result = jobs.validated_intake(
        spark, path, f"{folder}/out", parties, products, existing, targets=targets, at=AT, by="GS1", files=1,
        count_lines=True,
    )
    c = result.counts
    assert {k: c[k] for k in (
        "malformed", "missing_required", "missing_product_group", "unknown_customer", "unknown_contact",
        "unknown_product", "update", "insert", "inserted", "duplicates",
    )} == {
        "malformed": 2, "missing_required": 1, "missing_product_group": 1, "unknown_customer": 2,
        "unknown_contact": 1, "unknown_product": 1, "update": 1, "insert": 4, "inserted": 3, "duplicates": 1,
    }
    # Every line of the file is in exactly one class.
    classes = ["malformed", "missing_required", "missing_product_group", "unknown_customer",
               "unknown_contact", "unknown_product", "update", "duplicates", "inserted"]
    assert c["physical_lines"] == 1 + sum(c[k] for k in classes)
    assert (c["outperformed"], c["met"], c["underperformed"]) == (1, 1, 1)
    assert [r.leadName for r in result.frames["duplicates"].collect()] == ["second"]
    assert [r.leadName for r in result.frames["updates"].collect()] == ["update"]

    # Ids start above the highest in the table: no old lead is overwritten.
    loaded = spark.table(targets.leads)
    assert {r.LEAD_ID: r.LEAD_NUMBER for r in loaded.collect()} == {40: "L0", 42: "L2", 44: "L3", 53: "L11"}
    lead = loaded.filter("LEAD_ID = 44").first()
    assert lead.LEAD_NAME == "quoted, comma" and lead.CITY == "C, x"
    assert lead.DEAL_SIZE is None  # not in the insert list
    assert lead.CREATION_DATE == datetime(2006, 1, 1) and lead.CREATED_BY == "GS1"
    members, items = spark.table(targets.members), spark.table(targets.items)
    assert {r.LEAD_ID: r.PARTY_ROLE for r in members.collect()} == {42: "R", 44: "R", 53: "R"}
    assert {r.LEAD_ID: (r.PRODUCT_GROUP_ID, r.CONV_CURR_CODE) for r in items.collect()}[42] == (5, "USD")

    bad = read_delimited(spark, f"{folder}/out/format_errors")
    assert {r.FILE_RECORD_NUM: r.malformed_line for r in bad.collect()} == {"11": FILE_A[10], "12": FILE_A[11]}
    reasons = {g.rsplit("=", 1)[1] for g in glob.glob(f"{folder}/out/rejects/reject_reason=*")}
    assert reasons == {"missing_required", "missing_product_group", "unknown_customer", "unknown_contact", "unknown_product"}
    assert read_delimited(spark, f"{folder}/out/success/leads").count() == 3


def test_load_that_broke_off_is_completed(spark, folder):
    parties, products, existing = references(spark)
    targets = tables()
    path = lead_file(folder, schemas.LEAD_FILE, FILE_A)
    run = lambda t: jobs.validated_intake(
        spark, path, f"{folder}/out", parties, products, existing, targets=t, at=AT, by="GS1", files=1
    )
    run(targets)
    want = rows(spark.table(targets.items))
    # As if the load had ended before the leads went in.
    again = jobs.LeadTables(targets.leads + "_late", targets.members, targets.items)
    run(again)
    assert rows(spark.table(targets.items)) == want
    assert rows(spark.table(again.leads)) == rows(spark.table(targets.leads))
    # The next load of the file gets ids of its own.
    run(targets)
    assert spark.table(targets.leads).count() == spark.table(targets.items).count() == 6
    jobs.clean_lead_tables(spark, targets)
    assert spark.table(targets.items).isEmpty()


def test_intake_without_inserts_loads_nothing(spark, folder):
    parties, products, existing = references(spark)
    targets = tables()
    path = lead_file(folder, schemas.LEAD_FILE, FILE_A[:1])
    result = jobs.validated_intake(
        spark, path, f"{folder}/out", parties, products, existing, targets=targets, at=AT, by="GS1"
    )
    assert result.counts["inserted"] == 0 and "leads" not in result.frames
    assert not spark.catalog.tableExists(targets.leads)


def test_a_broken_off_load_leaves_nothing_for_the_next_file(spark, folder, monkeypatch):
    parties, products, _ = references(spark)
    existing = ReferenceList(spark.createDataFrame([], "lead_number string"), "lead_number")
    targets = tables()
    real = jobs._load

    def failing(spark, table, *rest):
        if table == targets.leads:
            raise OSError("lost")
        real(spark, table, *rest)

    def load(out, *lines):
        return jobs.validated_intake(
            spark, lead_file(folder, schemas.LEAD_FILE, lines), f"{folder}/{out}", parties, products, existing, targets=targets, at=AT, by="GS1"
        )

    with monkeypatch.context() as m:
        m.setattr(jobs, "_load", failing)
        with pytest.raises(OSError):
            load("a", *[f"A{k},1,2,a,5,C,S,US,U,R,5,USD,9" for k in range(3)])
    load("b", *[f"B{k},1,3,b,5,C,S,US,U,R,5,USD,9" for k in range(2)])
    assert rows(spark.table(targets.leads).select("LEAD_ID", "LEAD_NUMBER")) == [(1, "B0"), (2, "B1")]
    assert rows(spark.table(targets.members).select("LEAD_ID", "PARTY_ID")) == [(1, 3), (2, 3)]
    assert spark.table(targets.items).count() == 2


def wide(line):
    f = line.split(",")
    return ",".join([*f[:8], f[12], f[8], f[9], f[10], f[11]])


def test_staged_intake_wide(spark, folder):
    parties, products, _ = references(spark)
    targets = tables()
    lines = [wide(l) for l in FILE_A if '"' not in l and l.count(",") == 12]
    path = lead_file(folder, schemas.LEAD_FILE_WIDE, lines)
    old = spark.createDataFrame([(1, "L1", datetime(2000, 1, 1))], "LEAD_ID long, LEAD_NUMBER string, CREATION_DATE timestamp_ntz")
    publish(old.select(*[
        (F.col(f.name) if f.name in old.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.LEADS
    ]), targets.leads)
    result = jobs.staged_intake(
        spark, path, f"{folder}/out", parties, products, targets, at=AT, by="PLSQL", batch_id=3, files=1
    )
    status = {int(r.FILE_RECORD_NUM): (r.IMPORT_STATUS_CODE, r.IMPORT_MODE) for r in result.frames["status"].collect()}
    assert status == {
        1: ("S", "U"), 2: ("S", None), 3: ("S", None), 4: ("E", None), 5: ("E", None), 6: ("E", None),
        7: ("E", None), 11: ("S", None),
    }
    leads = {r.LEAD_ID: r for r in spark.table(targets.leads).collect()}
    assert set(leads) == {1, 3, 4, 12}  # a known number keeps its id, others lie above the highest
    # Key, number and creation stay on update; repeated lead numbers are all loaded.
    assert leads[1].LEAD_NUMBER == "L1" and leads[1].CREATION_DATE == datetime(2000, 1, 1)
    assert leads[1].LEAD_NAME == "update" and leads[1].DEAL_SIZE == 5
    assert leads[3].LEAD_NUMBER == leads[4].LEAD_NUMBER == "L2"
    members = spark.table(targets.members)
    assert rows(members.select("MKL_LEAD_TC_MEMBER_ID", "LEAD_ID")) == [
        ("00000001001", 1), ("00000001002", 3), ("00000001003", 4), ("00000001004", 12),
    ]
    assert spark.table(targets.items).count() == 4
    errors = {(r.ERROR_ID, int(r.FILE_RECORD_NUM), r.ERROR_MESSAGE) for r in result.frames["errors"].collect()}
    assert errors == {
        ("00000009001", 6, L.INVALID_PRODUCT), ("00000009002", 7, L.INVALID_PRODUCT),
        ("00000009101", 4, L.INVALID_CUSTOMER), ("00000009201", 5, L.INVALID_CONTACT),
    }
    report = read_delimited(spark, f"{folder}/out/status")
    assert report.columns == schemas.STATUS_REPORT
    assert [int(r.FILE_RECORD_NUM) for r in report.collect()] == [1, 2, 3, 4, 5, 6, 7, 11]
    assert read_delimited(spark, f"{folder}/out/errors").columns == schemas.ERROR_REPORT
    assert result.counts["rejected_missing_product_group"] == 1

    jobs.clean_lead_tables(spark, targets)
    assert {r.LEAD_ID for r in spark.table(targets.leads).collect()} == set()
    assert spark.table(targets.members).count() == 0


def kept_tables(store=None):
    tag = uuid.uuid4().hex[:8]
    return jobs.LeadTables(*[f"{n}_{tag}" for n in ("leads", "members", "items", "staging", "errors")], store=store)


def read(spark, targets, table):
    name = getattr(targets, table)
    return targets.store.read(name) if targets.store else spark.table(name)


def snapshot(spark, targets):
    return [rows(read(spark, targets, t)) for t in ("leads", "members", "items", "errors")]


def test_two_batches_and_a_repeated_one(spark, folder):
    parties, products, _ = references(spark)
    targets = kept_tables()

    def load(number, lines, out=None, **more):
        path = lead_file(folder, schemas.LEAD_FILE_WIDE, lines)
        return jobs.staged_intake(spark, path, f"{folder}/out{out or number}", parties, products, targets, at=AT, by="PLSQL", batch_id=number, **more)

    first = ["A1,1,2,one,5,C,S,US,9,U,R,5,USD", "A2,1,2,two,5,C,S,US,9,U,R,5,USD", "A2,3,2,again,5,C,S,US,9,U,R,6,USD", "A3,77,2,bad,5,C,S,US,9,U,R,5,USD"]
    second = ["B1,1,2,beta one,5,C,S,US,9,U,R,5,USD", "A1,4,2,changed,6,C,S,US,9,U,R,5,USD", "B2,1,88,bad,5,C,S,US,9,U,R,5,USD"]
    load(1, first)
    load(2, second)
    leads = {r.LEAD_ID: (r.LEAD_NUMBER, r.LEAD_NAME, r.CUSTOMER_ID) for r in spark.table(targets.leads).collect()}
    # Ids of the first file reach 4 in staging; the second starts above.
    assert leads == {1: ("A1", "changed", 4), 2: ("A2", "two", 1), 3: ("A2", "again", 3), 5: ("B1", "beta one", 1)}
    members = spark.table(targets.members)
    assert rows(members.select("MKL_LEAD_TC_MEMBER_ID", "LEAD_ID", "BATCH_ID")) == [
        ("00000001001", 1, 1), ("00000001002", 2, 1), ("00000001003", 3, 1), ("00000001004", 5, 2), ("00000001005", 1, 2),
    ]
    staging = spark.table(targets.staging)
    assert {(r.BATCH_ID, r.IMPORT_STATUS_CODE): r.n for r in staging.groupBy("BATCH_ID", "IMPORT_STATUS_CODE").agg(F.count("*").alias("n")).collect()} == {
        (1, "S"): 3, (1, "E"): 1, (2, "S"): 2, (2, "E"): 1,
    }
    before = snapshot(spark, targets)
    with pytest.raises(ValueError, match="batch 2 is in use"):
        load(2, second, out="other")
    with pytest.raises(ValueError, match="exists already"):
        load(3, second, out=2)
    assert snapshot(spark, targets) == before
    load(2, second, replace=True)
    assert snapshot(spark, targets) == before
    with pytest.raises(ValueError, match="more than once"):
        load(4, [second[1], second[1]])
    assert snapshot(spark, targets) == before


def test_a_staged_load_that_breaks_off_is_completed(spark, folder, monkeypatch):
    parties, products, _ = references(spark)
    targets = kept_tables()
    path = lead_file(folder, schemas.LEAD_FILE_WIDE, ["A1,1,2,one,5,C,S,US,9,U,R,5,USD", "A2,1,2,two,5,C,S,US,9,U,R,5,USD"])
    args = (spark, path, f"{folder}/out", parties, products, targets)
    with monkeypatch.context() as m:
        m.setattr(jobs.leads, "item_rows", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.staged_intake(*args, at=AT, by="PLSQL", batch_id=7)
    assert spark.table(targets.leads).count() == 2 and spark.table(targets.members).count() == 2
    jobs.staged_intake(*args, at=AT, by="PLSQL", batch_id=7, replace=True)
    assert [spark.table(t).count() for t in (targets.leads, targets.members, targets.items)] == [2, 2, 2]
    assert {r.IMPORT_STATUS_CODE for r in spark.table(targets.staging).collect()} == {"S"}


def test_error_keys_stay_unique(spark):
    status = spark.range(450).select(
        F.lit(1).alias("BATCH_ID"), F.col("id").alias("FILE_RECORD_NUM"), F.lit("E").alias("IMPORT_STATUS_CODE"),
        F.element_at(F.array(*map(F.lit, L.ERROR_BASES)), (F.col("id") % 3 + 1).cast("int")).alias("ERROR_MESSAGE"),
    )
    usual = L.error_log(status)
    assert usual.select("BATCH_ID", "ERROR_MESSAGE", "ERROR_ID").distinct().count() == 450
    apart = L.error_log(status, {m: k * 10**12 for k, m in enumerate(L.ERROR_BASES)})
    assert apart.select("ERROR_ID").distinct().count() == 450


def test_staged_intake_narrow(spark, folder):
    parties, _, _ = references(spark)
    targets = tables()
    lines = ["A,1,2,n,5,C,S,,9", "B,77,2,n,5,C,S,US,9", "C,1,,n,5,C,S,US,9", "D,1,2,n,5,C,S,US,9"]
    path = lead_file(folder, schemas.LEAD_FILE_NARROW, lines)
    result = jobs.staged_intake(spark, path, f"{folder}/out", parties, None, targets, at=AT, by="PLSQL")
    assert result.counts["S"] == 2 and result.counts["E"] == 1 and result.counts["rejected_missing_required"] == 1
    assert {r.LEAD_NUMBER for r in spark.table(targets.leads).collect()} == {"A", "D"}
    assert not spark.catalog.tableExists(targets.members)
    jobs.clean_lead_tables(spark, targets)
    assert {r.LEAD_NUMBER for r in spark.table(targets.leads).collect()} == {"A"}


def test_direct_upsert_of_schools(spark, folder):
    table = "school_" + uuid.uuid4().hex[:8]
    path = f"{folder}/schools.csv"

    def load(*lines):
        with open(path, "w") as out:
            out.write("schoolID,schoolName,schoolCity,schoolState,schoolNickName\n" + "\n".join(lines) + "\n")
        return jobs.direct_upsert(spark, path, table, schemas.SCHOOL, ["schoolID"], schemas.SCHOOL_UPDATES)

    load("1,One,C,S,N", '2,"Two, North",C,S,N')
    got = load("2,Two,C2,,N2", "3,Three,C,S,N", "2,Last,C3,S,N3")
    assert rows(got) == [("1", "One", "C", "S", "N"), ("2", "Last", "C3", "S", "N3"), ("3", "Three", "C", "S", "N")]
    # Loading the same file again changes nothing.
    assert rows(load("2,Two,C2,,N2", "3,Three,C,S,N", "2,Last,C3,S,N3")) == rows(got)


def test_reference_upload(spark, folder):
    table = "groups_" + uuid.uuid4().hex[:8]
    with open(f"{folder}/p.csv", "w") as out:
        out.write("ProdGroupId,Language,SourceLang,ProdGroupName,AdminProdGroupName\n1,US,US,A,AA\n2,US,US,B,BB\n")
    for _ in range(2):
        got = jobs.reference_upload(spark, f"{folder}/p.csv", table, schemas.PRODUCT_RENAMES, at=AT, by="GS1")
    assert got.count() == 4
    assert set(got.columns) == set(schemas.PRODUCT_GROUPS.fieldNames())
    rows_with_id = jobs.reference_rows(
        spark.range(3).withColumnRenamed("id", "a"), {"a": "A"}, at=AT, by="GS1", id_column="PARTY_ID", id_start=500
    )
    assert min(r.PARTY_ID for r in rows_with_id.collect()) >= 500


def batch_loader(spark, folder, targets):
    parties, products, _ = references(spark)

    def load(number, lines, **more):
        path = lead_file(folder, schemas.LEAD_FILE_WIDE, [f"{line},5,C,S,US,9,U,R,5,USD" for line in lines])
        out = f"{folder}/out{number}-{uuid.uuid4().hex[:6]}"
        return jobs.staged_intake(spark, path, out, parties, products, targets, at=AT, by="PLSQL", batch_id=number, **more)

    return load


@pytest.mark.parametrize("kind", ["catalog", "store"])
def test_a_corrected_batch_overwrites_no_other_lead(spark, folder, kind):
    targets = kept_tables(Store(spark, f"{folder}/store") if kind == "store" else None)
    load = batch_loader(spark, folder, targets)
    leads = lambda: {r.LEAD_NUMBER: (r.LEAD_ID, r.LEAD_NAME) for r in read(spark, targets, "leads").collect()}
    load(1, ["A,1,2,name A", "B,1,2,name B", "C,77,2,name C"])
    first = leads()
    assert first.keys() == {"A", "B"} and read(spark, targets, "errors").count() == 1
    # Shorter, with a new lead and without the error.
    load(1, ["B,1,2,name B", "D,1,2,name D"], replace=True)
    assert leads().keys() == {"B", "D"} and leads()["B"] == first["B"] and leads()["D"][0] not in {i for i, _ in first.values()}
    assert read(spark, targets, "errors").isEmpty() and read(spark, targets, "members").count() == read(spark, targets, "items").count() == 2
    before, ids = leads(), {r.FILE_RECORD_NUM: r.PK1 for r in read(spark, targets, "staging").collect()}
    # In another order: every row keeps its id.
    load(1, ["D,1,2,name D", "B,1,2,changed"], replace=True)
    assert leads() == {"B": (before["B"][0], "changed"), "D": before["D"]}
    assert {r.FILE_RECORD_NUM: r.PK1 for r in read(spark, targets, "staging").collect()} == {1: ids[2], 2: ids[1]}
    # Another batch updates one of them and adds its own; then nothing is left of the first file.
    load(2, ["B,1,3,by another", "E,1,2,name E"])
    load(1, [], replace=True)
    assert {n: name for n, (_, name) in leads().items()} == {"B": "by another", "E": "name E"}
    for table, size in (("members", 2), ("items", 2), ("errors", 0), ("staging", 2)):
        kept = read(spark, targets, table)
        assert kept.count() == size and {r.BATCH_ID for r in kept.collect()} <= {2}


@pytest.mark.parametrize("kind", ["catalog", "store"])
def test_repeated_numbers_of_a_corrected_batch_keep_their_ids(spark, folder, kind):
    targets = kept_tables(Store(spark, f"{folder}/store") if kind == "store" else None)
    load = batch_loader(spark, folder, targets)
    load(1, ["A,1,2,one", "A,1,2,two", "A,77,2,bad", "A,1,2,three"])
    before = {r.LEAD_NAME: r.LEAD_ID for r in read(spark, targets, "leads").collect()}
    load(1, ["A,1,2,one", "A,1,2,two", "A,1,2,mended", "A,1,2,three"], replace=True)
    after = {r.LEAD_NAME: r.LEAD_ID for r in read(spark, targets, "leads").collect()}
    assert {n: after[n] for n in before} == before and len(set(after.values())) == 4


def test_a_load_into_a_store_is_seen_whole_or_not_at_all(spark, folder, monkeypatch):
    store = Store(spark, f"{folder}/store")
    targets = kept_tables(store)
    load = batch_loader(spark, folder, targets)
    load(1, ["A,1,2,one", "B,77,2,bad"])
    before = snapshot(spark, targets)
    calls = ["merge", "replace_batch", "commit"]
    for call in calls:
        with monkeypatch.context() as m:
            m.setattr(jobs._Targets, call, lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                load(1, ["A,1,2,changed", "C,1,2,new"], replace=True)
        assert snapshot(spark, targets) == before
    load(1, ["A,1,2,changed", "C,1,2,new"], replace=True)
    assert {r.LEAD_NAME for r in store.read(targets.leads).collect()} == {"changed", "new"}
    with pytest.raises(ValueError, match="batch 1 is in use"):
        load(1, ["A,1,2,changed"])


def test_two_loads_at_once_share_no_id(spark, folder, monkeypatch):
    store = Store(spark, f"{folder}/store")
    targets = kept_tables(store)
    load = batch_loader(spark, folder, targets)
    load(1, ["A,1,2,one"])
    real, other = jobs._Targets.commit, []

    def late(self):
        # Another load runs from end to end before this one commits.
        if not other:
            other.append(1)
            load(3, ["X,1,2,ex", "Y,77,2,bad"])
        real(self)

    monkeypatch.setattr(jobs._Targets, "commit", late)
    with monkeypatch.context() as m:
        # No table is scanned for its highest id.
        m.setattr(jobs, "_highest_child", lambda *_: 1 / 0)
        with pytest.raises(Conflict):
            load(2, ["B,1,2,bee", "A,1,2,again"])
        load(2, ["B,1,2,bee", "A,1,2,again"], replace=True)
    leads = [(r.LEAD_ID, r.LEAD_NUMBER) for r in store.read(targets.leads).collect()]
    assert sorted(n for _, n in leads) == ["A", "B", "X"] and len({i for i, _ in leads}) == 3
    for table, key in (("members", "MKL_LEAD_TC_MEMBER_ID"), ("items", "PROD_ASSOC_ID")):
        ids = [r[key] for r in read(spark, targets, table).collect()]
        assert len(ids) == len(set(ids)) == 4


def test_files_of_a_load_that_breaks_off_are_not_seen(spark, folder, monkeypatch):
    parties, products, existing = references(spark)
    run = lambda lines: jobs.validated_intake(
        spark, lead_file(folder, schemas.LEAD_FILE, lines), f"{folder}/out", parties, products, existing, at=AT, by="GS1", runs=True
    )
    names = lambda: {r.LEAD_NAME for r in read_delimited(spark, f"{committed_run(spark, f'{folder}/out')}/success/leads").collect()}
    assert committed_run(spark, f"{folder}/out") is None
    run(FILE_A)
    before = names()
    real = jobs.write_csv

    def failing(df, path, **more):
        if path.endswith("success/members"):
            df = df.withColumn("PARTY_ROLE", F.raise_error(F.lit("lost")).cast("string"))
        real(df, path, **more)

    with monkeypatch.context() as m:
        m.setattr(jobs, "write_csv", failing)
        with pytest.raises(Exception, match="lost"):
            run(FILE_A[:2])
    assert names() == before == {"first", "quoted, comma", "no figures"}
    run(FILE_A[:2])
    assert names() == {"first"}


def test_rows_are_judged_again(spark, folder):
    parties, products, _ = references(spark)
    more = ReferenceList(spark.createDataFrame([(i,) for i in [*range(2, 20), 77]], "party_id long"), "party_id")
    for store in (None, Store(spark, f"{folder}/store")):
        targets = kept_tables(store)
        load = batch_loader(spark, folder, targets)
        load(1, ["A,5,2,kept", "B,77,2,mended", "C,99,2,bad", "D,1,2,lost"])
        load(2, ["E,5,2,kept", "B,77,2,mended too"])
        load(3, ["F,5,2,untouched"])
        got = jobs.revalidate_batches(spark, targets, (parties, products), (more, products))
        assert got == {"judged": 3, "loaded": 2, "errors": 1}
        status = {r.ATTRIBUTE_SMALL_CHAR005: (r.IMPORT_STATUS_CODE, r.ERROR_MESSAGE) for r in read(spark, targets, "staging").collect()}
        good, bad = ("S", None), ("E", L.INVALID_CUSTOMER)
        assert status == {"kept": good, "mended": good, "bad": bad, "lost": bad, "mended too": good, "untouched": good}
        assert {r.LEAD_NAME for r in read(spark, targets, "leads").collect()} >= {"kept", "mended", "mended too", "lost", "untouched"}
        members = read(spark, targets, "members").collect()
        assert len({r.MKL_LEAD_TC_MEMBER_ID for r in members}) == len(members) == 6 == read(spark, targets, "items").count()
        assert sorted((r.BATCH_ID, r.ERROR_ID) for r in read(spark, targets, "errors").collect()) == [(1, "00000009101"), (1, "00000009102")]
        # Lists that stay as they are change nothing, and no row is judged.
        assert jobs.revalidate_batches(spark, targets, (more, products), (more, products)) == {"judged": 0, "loaded": 0, "errors": 0}


def test_retired_batches(spark, folder):
    for store in (None, Store(spark, f"{folder}/store")):
        targets = kept_tables(store)
        load = batch_loader(spark, folder, targets)
        load(1, ["A,1,2,one", "B,77,2,bad"])
        load(2, ["C,1,2,one", "D,77,2,bad"])
        if store:
            assert jobs.batches_before(targets, "02") == [1, 2] and jobs.batches_before(targets, "00") == []
        jobs.retire_batches(spark, targets, [1, 9])
        assert {r.BATCH_ID for t in ("staging", "errors") for r in read(spark, targets, t).collect()} == {2}
        assert read(spark, targets, "leads").count() == 2


def test_counts_need_no_pass_of_their_own(spark, folder):
    parties, products, existing = references(spark)
    path = lead_file(folder, schemas.LEAD_FILE, FILE_A)
    tracker, group = spark.sparkContext.statusTracker(), f"intake-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "intake")
    try:
        result = jobs.validated_intake(spark, path, f"{folder}/out", parties, products, existing, at=AT, by="GS1")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    seen = tracker.getJobIdsForGroup(group)
    assert result.counts["inserted"] == 3
    print("JOBS", len(seen))
    assert 0 < len(seen) <= 40


def test_only_rows_that_pass_are_looked_up_in_a_large_list(spark, no_broadcast, monkeypatch):
    from sluice.schemas import CORRUPT

    names = f"leadNumber string, customerId long, primaryContactId long, leadName string, PartyUsageCode string, productGroupId long, {CORRUPT} string"
    lines = [("L1", 1, 1, "a", "u", 1, None), ("L2", 1, 1, "b", "u", 1, None), (None, 1, 1, "c", "u", 1, None), ("L1", 9, 1, "d", "u", 1, None), ("L1", 1, 1, "e", "u", 1, "bad")]
    rows = spark.createDataFrame(lines, names)
    ones, known = ReferenceList(spark.createDataFrame([(1,)], "k long"), "k"), ReferenceList(spark.createDataFrame([("L1",)], "k string"), "k")
    compared = []
    flag = jobs.flag_changes
    monkeypatch.setattr(jobs, "flag_changes", lambda df, *rest, **more: (compared.append(df.count()), flag(df, *rest, **more))[1])
    found = {r.leadName: r.outcome for r in jobs.intake_outcomes(rows, ones, ones, known).collect()}
    assert found == {"a": "update", "b": "insert", "c": "missing_required", "d": "unknown_customer", "e": "malformed"}
    assert compared == [2]


@pytest.mark.parametrize("file_rows", [1, 50_000])
def test_rows_set_apart_are_stored_once_with_a_large_list(spark, conf, folder, monkeypatch, file_rows):
    from sluice.sinks import files

    monkeypatch.setattr(files, "FILE_ROWS", file_rows)
    path, stored = lead_file(folder, schemas.LEAD_FILE, FILE_A), []
    keep = jobs.materialize

    def counted(df, label, **more):
        kept = keep(df, label, **more)
        stored.append((label, kept.count()))
        return kept

    monkeypatch.setattr(jobs, "materialize", counted)
    run = lambda out, **more: jobs.validated_intake(spark, path, f"{folder}/{out}", *references(spark), at=AT, by="GS1", **more)
    small = run("small")
    assert ("outcomes", len(FILE_A)) in stored
    conf("sluice.broadcastBytes", "-1")
    stored.clear()
    large = run("large", compression=None)
    # Only the update and the inserts are looked up and written again.
    assert ("outcomes", 5) in stored and ("judged", len(FILE_A)) in stored
    assert large.counts == small.counts and list(large.frames) == list(small.frames)
    for name, frame in small.frames.items():
        assert frame.columns == large.frames[name].columns and rows(frame) == rows(large.frames[name])
    for name, ending in (("small", ".csv.gz"), ("large", ".csv")):
        written = glob.glob(f"{folder}/{name}/**/part-*", recursive=True)
        assert written and all(f.endswith(ending) for f in written)
    for name in ("format_errors", "rejects", "success/leads", "success/members", "success/items"):
        a, b = (read_delimited(spark, f"{folder}/{out}/{name}") for out in ("small", "large"))
        assert a.columns == b.columns and rows(a) == rows(b) and not a.isEmpty()
