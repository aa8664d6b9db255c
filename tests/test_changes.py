import random

from helpers import plan, rows
from pyspark.sql import functions as F

from sluice.operators.changes import (
    class_counts, deal_buckets, deal_performance, deal_totals, dedup, dropped_duplicates, flag_changes,
    set_difference,
)
from sluice.operators.lookups import ReferenceList


def test_changes_are_split_by_known_key(spark):
    df = spark.createDataFrame([("L1",), ("L2",), ("L2",)], "number string")
    existing = ReferenceList(spark.createDataFrame([("L1",), ("L1",)], "lead_number string"), "lead_number")
    assert rows(flag_changes(df, "number", existing)) == [("L1", "update"), ("L2", "insert"), ("L2", "insert")]


def hot(spark, n=3000):
    draw = random.Random(2)
    data = [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{draw.randrange(200)}", i) for i in range(n)]
    draw.shuffle(data)
    return data, spark.createDataFrame(data, "k string, n int").repartition(4)


def test_dedup_and_duplicates_give_back_all_rows(spark):
    data, df = hot(spark)
    first = {}
    for k, n in data:
        first[k] = min(first.get(k, n), n)
    kept = dedup(df, ["k"], ["n"])
    assert rows(kept) == sorted(first.items(), key=repr)
    dropped = dropped_duplicates(df, kept, ["k"], ["n"])
    assert rows(dropped) == sorted((x for x in data if first[x[0]] != x[1]), key=repr)
    last = {}
    for k, n in data:
        last[k] = max(last.get(k, n), n)
    assert rows(dedup(df, ["k"], ["n"], keep="last")) == sorted(last.items(), key=repr)


def test_dedup_reduces_before_the_shuffle(spark):
    _, df = hot(spark)
    text = plan(dedup(spark.createDataFrame(df.collect(), df.schema), ["k"], ["n"]))
    assert "partial_min_by" in text and "Window" not in text


def test_result_does_not_depend_on_partitions(spark, conf):
    _, df = hot(spark)
    want = rows(dedup(df, ["k"], ["n"]))
    conf("spark.sql.shuffle.partitions", "13")
    assert rows(dedup(df.repartition(7), ["k"], ["n"])) == want


def test_set_difference_is_distinct(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    assert rows(set_difference(left, spark.createDataFrame([(2,)], "a int"))) == [(1,)]


def test_deal_figures(spark):
    big = 2_000_000_000
    df = spark.createDataFrame(
        [(5, 10), (10, 10), (10, 5), (None, 5), (5, None), (-big, big)], "deal int, budget int"
    )
    judged = df.withColumn("p", deal_performance("budget", "deal"))
    assert judged.filter("p = 4000000000").count() == 1
    assert deal_buckets(judged, "p").first().asDict() == {"outperformed": 2, "met": 1, "underperformed": 1}
    assert deal_totals(df, "deal", "budget").first().asDict() == {
        "total_deal_size": 30 - big, "total_budget": 30 + big,
    }
    sign = judged.select(F.signum("p").alias("s"))
    assert rows(class_counts(sign, "s")) == [(-1.0, 1), (0.0, 1), (1.0, 2), (None, 2)]


def test_rows_that_are_not_stored_are_made_once(spark, no_broadcast):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(f"a{i % 40}",) for i in range(200)], "k string").mapInArrow(count, "k string")
    listed = spark.createDataFrame([(f"a{i}",) for i in range(20)], "k string")
    marked = flag_changes(df, "k", ReferenceList(listed, "k"))
    assert marked.filter("change = 'update'").count() == 100
    assert made.value == 200
