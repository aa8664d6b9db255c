"""Tables of file sets: merges by file, changes beside the base, one commit, claims of ids."""

import pytest
from helpers import rows
from pyspark.sql import functions as F, types as T

from sluice.operators.upsert import upsert
from sluice.sinks.records import Claims, create, names, read
from sluice.sinks.store import Conflict, Store

SCHEMA = T.StructType().add("id", "long").add("name", "string").add("note", "string")


@pytest.fixture
def store(spark, folder):
    return Store(spark, f"{folder}/store")


def filled(store, n=1000, files=100, keys=("id",), **more):
    """n rows, written in ``files`` files by ranges of the key."""
    rows = store.spark.range(n).select("id", F.concat(F.lit("n"), "id").alias("name"), F.lit("old").alias("note"))
    t = store.begin()
    t.create("t", SCHEMA, keys, **more)
    t.append("t", rows.repartitionByRange(files, "id"))
    t.commit()


def changed(spark, ids, name="new"):
    return spark.createDataFrame([(i, name) for i in ids], "id long, name string")


def paths(store):
    return {r.file for r in store.begin().files("t").collect()}


@pytest.mark.parametrize("small", [True, False])
def test_a_merge_rewrites_only_the_files_it_hits(spark, store, conf, small):
    filled(store)
    before, whole = paths(store), rows(store.read("t"))
    if not small:
        conf("sluice.broadcastBytes", "-1")
    source = changed(spark, [*range(500, 510), 2000])
    t = store.begin()
    hit = t.merge("t", source, lambda part: upsert(part, source, ["id"], ["name"]))
    assert rows(store.read("t")) == whole  # not yet committed
    t.commit()
    after = paths(store)
    assert len(before) == 100
    if small:
        assert hit == len(before - after) <= 2
    want = {i: (f"n{i}", "old") for i in range(1000)} | {i: ("new", "old") for i in range(500, 510)} | {2000: ("new", None)}
    assert {r.id: (r.name, r.note) for r in store.read("t").collect()} == want


def test_the_bitmap_spares_files_of_overlapping_ranges(spark, store):
    filled(store)
    scattered = Store(spark, store.root + "2")
    t = scattered.begin()
    t.create("t", SCHEMA, ["id"])
    t.append("t", store.read("t").repartition(50, F.xxhash64("id")))
    t.commit()
    source = changed(spark, [7, 900])
    found = t.hit_files("t", source).count()
    assert 2 <= found <= 4
    assert t.hit_files("t", changed(spark, [None])).count() == 0


def test_composite_and_text_keys(spark, store):
    schema = T.StructType().add("a", "string").add("b", "integer").add("v", "integer")
    t = store.begin()
    t.create("t", schema, ["a", "b"])
    t.append("t", spark.createDataFrame([(f"é{k % 9}", k, k) for k in range(300)] + [(None, 1, 5)], schema).repartitionByRange(10, "a", "b"))
    t.commit()
    source = spark.createDataFrame([("é3", 12, -1), ("é3", 13, -2), (None, 1, -3)], schema)
    t.merge("t", source, lambda part: upsert(part, source, ["a", "b"], ["v"]))
    t.commit()
    got = [tuple(r) for r in store.read("t").collect()]
    assert ("é3", 12, -1) in got and ("é3", 13, -2) in got and got.count((None, 1, 5)) == got.count((None, 1, -3)) == 1
    assert len(got) == 303


def test_changes_beside_the_base_equal_merges(spark, store):
    filled(store, n=50, files=5, updates=["name"])
    merged = Store(spark, store.root + "2")
    filled(merged, n=50, files=5)
    steps = [
        [(3, "a", "x"), (60, "first", "kept"), (None, "n1", "x")], [(3, "b", "y"), (4, "c", "y")], [(60, "second", "lost"), (None, "n2", "x")],
    ]
    for step in steps:
        df = spark.createDataFrame(step, SCHEMA)
        t = store.begin()
        t.log_changes("t", df)
        t.commit()
        m = merged.begin()
        m.merge("t", df, lambda part: upsert(part, df, ["id"], ["name"]))
        m.commit()
    base = {f for f in paths(store)}
    assert rows(store.read("t")) == rows(merged.read("t"))
    found = {r.id: (r.name, r.note) for r in store.read("t").collect()}
    assert found[3] == ("b", "old") and found[60] == ("second", "kept")
    t = store.begin()
    assert t.compact("t") <= 2
    t.commit()
    assert rows(store.read("t")) == rows(merged.read("t"))
    assert t.files("t").filter("kind = 'change'").isEmpty() and len(base & paths(store)) >= 3
    # A merge after changes puts them in first.
    t = store.begin()
    t.log_changes("t", spark.createDataFrame([(5, "logged", "x"), (6, "logged", "x")], SCHEMA))
    source = changed(spark, [6])
    t.merge("t", source, lambda part: upsert(part, source, ["id"], ["name"]))
    t.commit()
    found = {r.id: r.name for r in store.read("t").collect()}
    assert (found[5], found[6]) == ("logged", "new")
    with pytest.raises(ValueError, match="more than once"):
        t.log_changes("t", changed(spark, [1, 1]))


def test_two_changes_in_one_transaction(spark, store):
    filled(store, n=5, files=1, updates=["name"])
    t = store.begin()
    t.log_changes("t", changed(spark, [1], "first"))
    t.log_changes("t", changed(spark, [1], "second"))
    t.commit()
    assert {r.id: r.name for r in store.read("t").collect()}[1] == "second"


def test_tags_are_replaced_and_dropped(spark, store):
    t = store.begin()
    t.create("t", SCHEMA)
    for tag in ("1", "2", "3"):
        t.append("t", changed(spark, [int(tag)] * 3), tag)
    t.commit()
    files = paths(store)
    t = store.begin()
    t.replace_tag("t", changed(spark, [20]), "2")
    t.replace_tag("t", changed(spark, []), "3")
    t.commit()
    assert [r.id for r in store.read("t").orderBy("id").collect()] == [1, 1, 1, 20]
    assert [r.id for r in store.read("t", ["2"]).collect()] == [20] and store.read("t", ["3"]).isEmpty()
    t = store.begin()
    t.drop_tags("t", ["1"])
    t.commit()
    assert [r.id for r in store.read("t").collect()] == [20] and files & paths(store) == set()


def test_all_tables_change_at_once_or_none(spark, store, monkeypatch):
    t = store.begin()
    for name in ("a", "b", "c"):
        t.create(name, SCHEMA)
        t.append(name, changed(spark, [1]))
    t.commit()
    sizes = lambda: [store.read(n).count() for n in ("a", "b", "c")]
    for broken in ("a", "b", "c"):
        t = store.begin()
        for name in ("a", "b", "c"):
            if name == broken:
                break
            t.append(name, changed(spark, [2]))
        # The load ends here.
        assert sizes() == [1, 1, 1]
    t = store.begin()
    for name in ("a", "b", "c"):
        t.append(name, changed(spark, [2]))
    t.commit()
    assert sizes() == [2, 2, 2]


def test_loads_at_the_same_time(spark, store):
    filled(store, n=10, files=2)
    first, second, third = store.begin(), store.begin(), store.begin()
    first.append("t", changed(spark, [100]))
    second.append("t", changed(spark, [200]))
    second.create("other", SCHEMA)
    second.append("other", changed(spark, [1]))
    source = changed(spark, [5])
    third.merge("t", source, lambda part: upsert(part, source, ["id"], ["name"]))
    assert first.commit() == 2 and second.commit() == 3
    with pytest.raises(Conflict):
        third.commit()
    assert sorted(r.id for r in store.read("t").collect()) == [*range(10), 100, 200]
    assert store.read("other").count() == 1 and store.read("t").filter("name = 'new'").count() == 2


def test_many_logs_become_one(spark, store, monkeypatch):
    monkeypatch.setattr("sluice.sinks.store.LOGS", 3)
    filled(store, n=4, files=1)
    for k in range(5):
        t = store.begin()
        t.append("t", changed(spark, [10 + k]))
        t.commit()
    assert len(t.tables["t"]["logs"]) <= 3 and store.read("t").count() == 9


def test_records_are_created_once(spark, folder):
    path = f"{folder}/r/{1:03d}"
    assert create(spark, path, {"a": 1}) and not create(spark, path, {"a": 2})
    assert read(spark, path) == {"a": 1} and names(spark, f"{folder}/r") == ["001"] and names(spark, f"{folder}/none") == []


def test_claims_of_two_loads(spark, folder, monkeypatch):
    one, two = Claims(spark, f"{folder}/ids"), Claims(spark, f"{folder}/ids")
    assert one.claim("lead", 10, first=41) == 41
    # The other load claims between the look-up and the claim of this one.
    real, raced = create, []

    def late(spark, path, record):
        if not raced:
            raced.append(two.claim("lead", 5))
        return real(spark, path, record)

    with monkeypatch.context() as m:
        calls = iter([late, real, real])
        m.setattr("sluice.sinks.records.create", lambda *a: next(calls)(*a))
        got = one.claim("lead", 7)
    assert raced == [51] and got == 56
    assert two.claim("lead", 3, owner="batch 1") == 63 and one.claim("lead", 2, owner="batch 1") == 63
    assert one.claim("lead", 9, owner="batch 1") == 66 and one.claim("lead", 1, first=lambda: 1 / 0) == 75
    assert one.take("batch", 7, at="now") and not two.take("batch", 7) and two.taken("batch")[7]["at"] == "now"


def test_a_delete_rewrites_only_files_with_such_rows(spark, store):
    filled(store, n=100, files=10)
    before = paths(store)
    t = store.begin()
    assert t.delete("t", F.col("id").between(25, 31) | (F.col("id") > 89)) == 3
    t.commit()
    assert sorted(r.id for r in store.read("t").collect()) == [*range(25), *range(32, 90)]
    assert len(before & paths(store)) == 7 and t.delete("t", F.col("id") < 0) == 0
    # What is left of a file keeps its tag.
    t.create("tagged", SCHEMA)
    t.append("tagged", changed(spark, [1, 2, 3]), "a")
    t.append("tagged", changed(spark, [4]), "b")
    t.delete("tagged", F.col("id") == 2)
    t.commit()
    assert sorted(r.id for r in store.read("tagged", ["a"]).collect()) == [1, 3]
