import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from sluice.operators.lookups import (
    ReferenceList, flag_known, flag_not_in, hot_keys, in_reference, left_join_unique, measured_bytes,
    not_in_reference,
)


def keyed(spark, values, name="k", kind="long"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def skewed(spark, n=4000):
    """A third of the rows share one key, a tenth have none, rows are exact copies."""
    draw = random.Random(1)
    values = [7 if i % 3 == 0 else None if i % 10 == 1 else draw.randrange(500) for i in range(n)]
    return spark.createDataFrame([(v, i % 50) for i, v in enumerate(values)], "k long, v int").repartition(4)


def expected_flags(df, known):
    return sorted(((r.k, r.v, r.k in known) for r in df.collect()), key=repr)


@pytest.mark.parametrize("with_null", [False, True])
def test_small_and_large_reference_agree(spark, conf, with_null):
    df = skewed(spark).persist()
    known = [*range(0, 300, 2), 7, 7, 7] + ([None] if with_null else [])
    want = expected_flags(df, set(known))
    reference = lambda: ReferenceList(keyed(spark, known), "k")
    assert rows(flag_known(df, "k", reference(), "f")) == want
    # Large reference, few unknown values: they are broadcast.
    conf("sluice.broadcastBytes", "12000")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert rows(flag_known(df, "k", ReferenceList(keyed(spark, [*known, *range(1000, 3000)]), "k"), "f")) == want
    # Large reference, few known values.
    few = ReferenceList(keyed(spark, [7, *range(1000, 3000)]), "k")
    text = plan(flag_known(df, "k", few, "f"))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    assert rows(flag_known(df, "k", few, "f")) == expected_flags(df, {7})
    # Everything large, hot keys salted.
    conf("sluice.broadcastBytes", "-1")
    conf("sluice.hotRows", "10")
    salted = flag_known(df, "k", reference(), "f")
    assert "__salt" in plan(salted)
    assert rows(salted) == want
    df.unpersist()


def test_hot_keys_are_found_and_spread(spark, conf, no_broadcast):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = skewed(spark)
    conf("spark.sql.shuffle.partitions", "16")
    hot = hot_keys(df, F.xxhash64("k"))
    by_hash = {r.h: r.k for r in df.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    tasks = {by_hash[h]: n for n, hashes in hot.items() for h in hashes}
    assert tasks[7] == 8 and tasks[None] == 2
    assert hot_keys(df.limit(0), F.xxhash64("k")) == {}
    names = keyed(spark, range(500)).withColumn("name", F.concat(F.lit("n"), "k"))
    joined = left_join_unique(df, names, [("k", "k")])
    want = sorted(((r.k, r.v, None if r.k is None else f"n{r.k}") for r in df.collect()), key=repr)
    assert rows(joined) == want
    # The hot key does not end in one task.
    spread = joined.filter("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 1


def test_null_matches_null_only_when_null_safe(spark):
    df = keyed(spark, [1, None])
    with_null, without = keyed(spark, [1, None]), keyed(spark, [1])
    assert rows(in_reference(df, "k", ReferenceList(with_null, "k"))) == [(1,), (None,)]
    assert rows(in_reference(df, "k", ReferenceList(without, "k"))) == [(1,)]
    assert rows(not_in_reference(df, "k", ReferenceList(without, "k"))) == [(None,)]
    flagged = flag_known(df, "k", ReferenceList(with_null, "k"), "f", null_safe=False)
    assert rows(flagged) == [(1, True), (None, False)]


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("reference", [[1, 2], [1, None], [], [None]])
def test_not_in_follows_sql(spark, conf, reference, large):
    if large:
        conf("sluice.broadcastBytes", "-1")
    df = keyed(spark, [1, 3, None])
    keyed(spark, reference).createOrReplaceTempView("ref")
    df.createOrReplaceTempView("src")
    want = rows(spark.sql("SELECT k FROM src WHERE k NOT IN (SELECT k FROM ref)"))
    got = flag_not_in(df, "k", ReferenceList(keyed(spark, reference), "k"), "f").filter("f").drop("f")
    assert rows(got) == want


def test_reference_takes_the_type_of_the_column(spark):
    texts = keyed(spark, ["12", "x"], kind="string")
    assert rows(in_reference(texts, "k", ReferenceList(keyed(spark, [12, 13]), "k"))) == [("12",)]
    longs = keyed(spark, [12, None])
    listed = ReferenceList(keyed(spark, ["12", "no number"], kind="string"), "k")
    assert rows(in_reference(longs, "k", listed)) == [(12,)]


def test_measured_bytes_counts_text(spark):
    short = keyed(spark, ["a"] * 10, kind="string")
    long = keyed(spark, ["a" * 1000] * 10, kind="string")
    assert measured_bytes(long) - measured_bytes(short) == 9990
    assert measured_bytes(short.select(F.array("k").alias("a"))) is None
    assert measured_bytes(short.limit(0)) == 0


def test_reference_repeats_do_not_multiply_rows(spark):
    df = keyed(spark, [1, 1, 2])
    assert flag_known(df, "k", ReferenceList(keyed(spark, [1, 1, 1]), "k"), "f").count() == 3


def test_few_values_leave_a_large_list_where_it_is(spark, conf, monkeypatch):
    conf("sluice.broadcastBytes", "10000")
    stored = []
    import sluice.operators.lookups as look

    monkeypatch.setattr(look, "materialize", lambda df, label: (stored.append(label), df)[1])
    rows_in = spark.createDataFrame([(1,), (999_999,), (None,)], "k long")
    listed = ReferenceList(spark.range(5000).withColumnRenamed("id", "x"), "x")
    got = {r.k: r.known for r in flag_known(rows_in, "k", listed, "known").collect()}
    assert got == {1: True, 999_999: False, None: False}
    assert stored == ["used-values", "held-keys"]


@pytest.mark.parametrize("with_null", [False, True])
@pytest.mark.parametrize("kind", ["long", "string", "int"])
def test_whole_numbers_are_checked_as_bits(spark, conf, with_null, kind):
    conf("sluice.broadcastBytes", "4000")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    known = [*range(-300, 1200, 3), -(1 << 63), (1 << 63) - 1, 63, 64, 255, 256, 5, 5] + ([None] if with_null else [])
    values = [*range(-310, 310), None, 1199, 1200] if kind == "int" else [*range(-310, 310), None, 1199, 1200, -(1 << 63), (1 << 63) - 1]
    held = {str(k) if kind == "string" and k is not None else k for k in known}
    if kind == "string":
        values = [v if v is None else str(v) for v in values] + ["05", " 5", "+5", "-0", "5.0", "x", ""]
    reference = ReferenceList(keyed(spark, known), "k")
    assert not reference.fits(spark.createDataFrame([], f"k {kind}").schema["k"].dataType)
    df = keyed(spark, values, kind=kind).repartition(3)
    marked = flag_known(df, "k", reference, "f", bits_first=True)
    text = plan(marked)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert marked.columns == ["k", "f"]
    assert {r.k: r.f for r in marked.collect()} == {v: v in held for v in values}
    plain = {r.k: r.f for r in flag_known(df, "k", reference, "f", null_safe=False, bits_first=True).collect()}
    assert plain == {v: v is not None and v in held for v in values}


def test_scattered_whole_numbers_are_not_kept_as_bits(spark, conf):
    conf("sluice.broadcastBytes", "4000")
    reference = ReferenceList(spark.range(500).selectExpr("id * 1000 AS k"), "k")
    df = keyed(spark, [0, 5, 1000, 499_000, 500_000, None])
    assert reference.bits(df.schema["k"].dataType) is None
    assert {r.k: r.f for r in flag_known(df, "k", reference, "f", bits_first=True).collect()} == {0: True, 5: False, 1000: True, 499_000: True, 500_000: False, None: False}
