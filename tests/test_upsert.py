import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from sluice.operators.upsert import delete_where, merge_rows, upsert
from sluice.sinks.tables import (
    append, current, drop_old_versions, overwrite_partitions, publish, touched,
)

TABLE = "k long, a string, b string"


def table(spark, data):
    return spark.createDataFrame(data, TABLE)


def test_listed_columns_change_others_stay(spark):
    target = table(spark, [(1, "a1", "b1"), (2, "a2", "b2")])
    source = table(spark, [(2, None, "new"), (3, "a3", "b3")])
    got = upsert(target, source, ["k"], ["a"], ["k", "a"])
    assert rows(got) == [(1, "a1", "b1"), (2, None, "b2"), (3, "a3", None)]


@pytest.mark.parametrize("large", [False, True])
def test_empty_sides(spark, conf, large):
    if large:
        conf("sluice.broadcastBytes", "-1")
    some, none = table(spark, [(1, "a", "b")]), table(spark, [])
    assert rows(upsert(none, some, ["k"], ["a"])) == [(1, "a", "b")]
    assert rows(upsert(some, none, ["k"], ["a"])) == [(1, "a", "b")]
    assert rows(upsert(none, none, ["k"], ["a"])) == []


def test_repeated_source_key(spark):
    target = table(spark, [(1, "a", "b")])
    source = table(spark, [(1, "x", "1"), (1, "y", "2"), (2, "p", "1"), (2, "q", "2")])
    assert rows(upsert(target, source, ["k"], ["a"], order_by=["b"])) == [(1, "y", "b"), (2, "q", "2")]
    with pytest.raises(ValueError, match="more than once"):
        upsert(target, source, ["k"], ["a"])


def test_null_key_is_inserted(spark):
    target = table(spark, [(None, "old", "b")])
    source = table(spark, [(None, "x", "1"), (None, "x", "1")])
    assert rows(upsert(target, source, ["k"], ["a"])) == sorted(
        [(None, "old", "b"), (None, "x", "1"), (None, "x", "1")], key=repr
    )


def test_composite_key_and_every_target_row_of_a_key(spark):
    target = spark.createDataFrame([(1, "US", "x"), (1, "DE", "y"), (1, "DE", "z")], "id long, lang string, name string")
    source = spark.createDataFrame([(1, "DE", "new"), (2, "DE", "two")], target.schema)
    assert rows(upsert(target, source, ["id", "lang"], ["name"])) == [
        (1, "DE", "new"), (1, "DE", "new"), (1, "US", "x"), (2, "DE", "two"),
    ]


def brute(target, source):
    state = {k: (k, a, b) for k, a, b in target}
    for k, a, b in sorted(source, key=lambda r: r[2]):
        state[k] = (k, a, state[k][2]) if k in state else (k, a, b)
    return sorted(state.values(), key=repr)


@pytest.mark.parametrize("large", [False, True])
def test_against_row_by_row_and_repeated(spark, conf, large):
    if large:
        conf("sluice.broadcastBytes", "-1")
        conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    draw = random.Random(4)
    old = [(i, f"a{i}", f"b{i}") for i in range(300)]
    new = [(draw.randrange(600) if i % 3 else 5, f"n{i}", f"{i:05d}") for i in range(900)]
    target, source = table(spark, old), table(spark, new).repartition(3)
    want = brute(old, [(k, a, b) for k, a, b in new])
    # The row by row loader inserts the first row of a new key, then updates it: b is the first's.
    once = upsert(target, source, ["k"], ["a"], order_by=["b"])
    assert [r[:2] for r in rows(once)] == [r[:2] for r in want]
    again = upsert(once, source, ["k"], ["a"], order_by=["b"])
    assert rows(again) == rows(once)


def test_small_source_leaves_the_target_in_place(spark, folder):
    spark.range(100000).selectExpr("id as k", "'a' as a", "'b' as b").write.parquet(folder + "/t")
    target = spark.read.parquet(folder + "/t")
    text = plan(upsert(target, table(spark, [(5, "x", "y")]), ["k"], ["a"]))
    changed = text[: text.index("LeftAnti")]
    assert "BroadcastHashJoin" in changed and "LeftOuter" in changed
    assert "SortMergeJoin" not in text
    # The keys of the target are read alone to find the new ones.
    assert "ReadSchema: struct<k:bigint>" in text


TRUTH = [(matched, code, mode) for matched in (True, False) for code in "IE" for mode in ("U", None)]


@pytest.mark.parametrize("large", [False, True])
def test_merge_truth_table(spark, conf, large):
    if large:
        conf("sluice.broadcastBytes", "-1")
    target = table(spark, [(i, "old", "kept") for i, (matched, _, _) in enumerate(TRUTH) if matched] + [(99, "old", "kept")])
    source = spark.createDataFrame(
        [(i, "new", "src", code, mode) for i, (_, code, mode) in enumerate(TRUTH)],
        "pk long, v string, w string, code string, mode string",
    )
    taken = F.col("code") == "I"
    got = merge_rows(
        target, source, [("k", "pk")], {"a": "v"}, {"k": "pk", "a": "v", "b": "w"},
        matched_when=taken & (F.col("mode") == "U"), insert_when=taken,
    )
    want = [(99, "old", "kept")]
    for i, (matched, code, mode) in enumerate(TRUTH):
        if matched:
            want.append((i, "new" if code == "I" and mode == "U" else "old", "kept"))
        elif code == "I":
            want.append((i, "new", "src"))
    assert rows(got) == sorted(want, key=repr)


def test_merge_refuses_two_updates_of_one_row(spark):
    target = table(spark, [(1, "a", "b")])
    source = table(spark, [(1, "x", "1"), (1, "y", "2")])
    with pytest.raises(ValueError, match="more than once"):
        merge_rows(
            target, source, [("k", "k")], {"a": "a"}, {"k": "k"}, matched_when=F.lit(True), insert_when=F.lit(True)
        ).collect()


def test_delete_keeps_rows_with_unknown_condition(spark):
    df = table(spark, [(1, "x", None), (2, None, None), (3, "y", None)])
    assert [r[0] for r in rows(delete_where(df, F.col("a") == "x"))] == [2, 3]


def test_publish_replaces_a_table_that_is_read(spark):
    name = "published"
    first = publish(table(spark, [(1, "a", "b")]), name)
    assert rows(first) == [(1, "a", "b")]
    second = publish(upsert(current(spark, name, first.schema), table(spark, [(2, "x", "y")]), ["k"], ["a"]), name)
    assert [r[0] for r in rows(second)] == [1, 2]
    assert rows(spark.table("published__v1")) == [(1, "a", "b")]
    publish(second, name)
    drop_old_versions(spark, name, keep=1)
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("published__v")] == ["published__v3"]
    assert rows(spark.table(name)) == rows(current(spark, name, first.schema))
    assert current(spark, "nowhere", first.schema).isEmpty()


def test_bucketed_target_is_not_shuffled(spark, conf):
    conf("sluice.broadcastBytes", "-1")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    target = publish(table(spark, [(i, "a", "b") for i in range(50)]), "bucketed", bucket_by=["k"], buckets=4)
    source = table(spark, [(7, "x", "y"), (70, "x", "y")])
    got = upsert(target, source, ["k"], ["a"])
    side = plan(got)
    side = side[side.index("LeftOuter"):side.index("LeftAnti")]
    scan = side.index("bucketed")
    assert "Exchange" not in side[:scan]
    assert got.count() == 51
    assert got.filter("a = 'x'").count() == 2


def test_append_matches_columns_by_name(spark):
    append(table(spark, [(1, "a", "b")]), "appended")
    append(table(spark, [(2, "a2", "b2")]).select("b", "k", "a"), "appended")
    assert rows(spark.table("appended")) == [(1, "a", "b"), (2, "a2", "b2")]


@pytest.mark.parametrize("large", [False, True])
def test_only_touched_partitions_are_rewritten(spark, conf, large):
    if large:
        conf("sluice.broadcastBytes", "-1")
    name = f"parted_{large}".lower()
    old = [(i, "old", "m%d" % (i % 4) if i % 9 else None) for i in range(60)]
    table(spark, old).write.partitionBy("b").saveAsTable(name)
    before = set(spark.table(name).filter("b in ('m1', 'm2')").inputFiles())
    target = spark.table(name)
    source = table(spark, [(3, "new", "m3"), (9, "moved", "m3"), (100, "added", "m0")])
    part = touched(target, source, [("k", "k")], "b", "b")
    assert {r.b for r in part.select("b").distinct().collect()} == {"m0", "m3", None}
    assert "PartitionFilters: [(b" in plan(part)
    want = rows(upsert(table(spark, old), source, ["k"], ["a"]).select("a", "b", "k"))
    overwrite_partitions(upsert(part, source, ["k"], ["a"]), name)
    assert rows(spark.table(name).select("a", "b", "k")) == want
    assert before <= set(spark.table(name).inputFiles())
    # The same load again changes nothing.
    part = touched(spark.table(name), source, [("k", "k")], "b", "b")
    overwrite_partitions(upsert(part, source, ["k"], ["a"]), name)
    assert rows(spark.table(name).select("a", "b", "k")) == want


def test_a_plain_table_is_accepted(spark):
    table(spark, [(1, "a", "b"), (2, "c", "d")]).write.saveAsTable("plain_one")
    publish(upsert(spark.table("plain_one"), table(spark, [(2, "x", "y")]), ["k"], ["a"]), "plain_one")
    assert rows(spark.table("plain_one")) == [(1, "a", "b"), (2, "x", "d")]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("plain_one__v")]


def test_append_goes_to_the_live_version(spark):
    publish(table(spark, [(1, "a", "b")]), "pub")
    table(spark, [(9, "orphan", "o")]).write.saveAsTable("pub__v2")
    append(table(spark, [(2, "c", "d")]), "pub")
    assert rows(spark.table("pub")) == [(1, "a", "b"), (2, "c", "d")]
    drop_old_versions(spark, "pub", keep=1)
    assert rows(spark.table("pub")) == [(1, "a", "b"), (2, "c", "d")]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("pub__v")] == ["pub__v1"]


def test_bucketing_is_kept(spark):
    publish(table(spark, [(i, "a", "b") for i in range(20)]), "buckets_stay", bucket_by=["k"], buckets=4)
    publish(upsert(spark.table("buckets_stay"), table(spark, [(2, "x", "y")]), ["k"], ["a"]), "buckets_stay")
    append(table(spark, [(50, "n", "n")]), "buckets_stay")
    assert spark.table("buckets_stay").count() == 21
    facts = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED buckets_stay__v2").collect()}
    assert facts["Num Buckets"] == "4"
