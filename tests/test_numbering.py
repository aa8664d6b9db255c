import random

import pytest
from helpers import plan, rows
from pyspark.sql import types as T

from sluice.functions.stamp import sequence_id, surrogate_id
from sluice.operators import numbering
from sluice.operators.numbering import dense_number, renumber
from sluice.sources.delimited import physical_lines, store_delimited


def values(n=2000):
    draw = random.Random(3)
    data = [("hot" if i % 3 == 0 else None if i % 11 == 0 else f"g{i % 5}", i) for i in range(n)]
    draw.shuffle(data)
    return data


def per_group(data):
    seen, out = {}, []
    for g, i in sorted(data, key=lambda x: x[1]):
        seen[g] = seen.get(g, 0) + 1
        out.append((g, i, seen[g]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parallel", ["1", "9"])
def test_dense_number_equals_sorted_position(spark, conf, parallel):
    conf("spark.sql.shuffle.partitions", parallel)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    data = values()
    df = spark.createDataFrame(data, "g string, i int")
    got = dense_number(df, ["g", "i"], "n", start=10)
    order = sorted(data, key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert rows(got) == sorted(((g, i, 10 + at) for at, (g, i) in enumerate(order)), key=repr)
    assert rows(dense_number(df, ["i"], "n", within=["g"])) == per_group(data)


def test_dense_number_of_large_offsets(spark, no_broadcast):
    data = values(500)
    df = spark.createDataFrame(data, "g string, i int")
    assert rows(dense_number(df, ["i"], "n", within=["g"])) == per_group(data)


def test_renumber_counts_what_is_left(spark, monkeypatch):
    monkeypatch.setattr(numbering, "RANGE_ROWS", 100)
    data = values()
    df = spark.createDataFrame(data, "g string, i long").repartition(5)
    assert rows(renumber(df, "i", "n", within=["g"])) == per_group(data)
    left = df.filter("i % 3 = 1")
    want = sorted(i for _, i in data if i % 3 == 1)
    assert sorted((r.i, r.n) for r in renumber(left, "i", "n", start=5).collect()) == [
        (i, 5 + at) for at, i in enumerate(want)
    ]


def test_renumber_shuffles_rows_once(spark, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(renumber(spark.range(10), "id", "n"))
    join = text[text.index("SortMergeJoin"):]
    rows_side, counts_side = join.split("row_number()")
    assert rows_side.count("Exchange") == 0
    # The rows once; their counts by range, in order, and by range again.
    assert counts_side.count("Exchange") == 4


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "g string, i long")
    assert rows(dense_number(empty, ["i"], "n")) == []
    assert rows(renumber(empty, "i", "n", within=["g"])) == []


def test_records_are_numbered_in_file_order(spark, conf, folder):
    # Small splits: several blocks per file and several files per task.
    conf("spark.sql.files.maxPartitionBytes", "2000")
    conf("spark.sql.files.openCostInBytes", "100")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    want = []
    for part in range(3):
        lines = [f"p{part}r{i}" for i in range(400 * (part + 1))]
        want += lines
        with open(f"{folder}/f{part}.csv", "w", newline="") as out:
            out.write("a,b\r\n" + "".join(f"{line},{i}\r\n" for i, line in enumerate(lines)))
    stored = store_delimited(spark, folder, schema)
    assert stored.columns == ["a", "b", "FILE_RECORD_NUM"]
    got = [r.a for r in stored.orderBy("FILE_RECORD_NUM").collect()]
    assert got == want
    numbers = sorted(r[0] for r in stored.select("FILE_RECORD_NUM").collect())
    assert numbers == list(range(1, len(want) + 1))
    assert physical_lines(spark, folder) == len(want) + 3


def test_ids(spark):
    df = spark.range(20).repartition(3)
    ids = [r.x for r in surrogate_id(df, "x", start=100).collect()]
    assert len(set(ids)) == 20 and min(ids) >= 100
    padded = sequence_id(df, ["id"], "x", base=9000)
    assert rows(padded)[0] == (0, "00000009001")
    assert {len(r.x) for r in padded.collect()} == {11}
