from helpers import plan, rows
from pyspark.sql import functions as F

from workload import fixtures as X


def test_staged_rows_are_ordered_before_their_fields_are_made(spark, folder, monkeypatch):
    lines = [(o, n, 10 * o + n, o + n, float(n), 1.5 * o, "A", "F") for o in range(1, 30) for n in range(1, 8)]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, names).write.parquet(f"{folder}/lineitem.parquet")
    orders = [(o, o % 9, "O", "1-URGENT") for o in range(1, 25)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    seen = []
    number = X.dense_number
    monkeypatch.setattr(X, "dense_number", lambda df, *rest, **more: (seen.append(df.columns), number(df, *rest, **more))[1])
    staged = X.staged(spark, folder)
    assert "leadName" not in seen[0] and "city" not in seen[0]
    want = [tuple(r) for r in X.lead_input(spark, folder).filter(X.L_VALID).orderBy(*X.ORDER).select("leadNumber", "leadName", "city", F.col("dealSize").cast("string")).collect()]
    got = staged.orderBy("FILE_RECORD_NUM").select(*[f"ATTRIBUTE_SMALL_CHAR00{i}" for i in (2, 5, 7, 6)], "FILE_RECORD_NUM").collect()
    assert 0 < len(want) < len(lines) and [tuple(r)[:-1] for r in got] == want
    assert [r.FILE_RECORD_NUM for r in got] == list(range(1, len(want) + 1))


def test_ordered_leads_are_shuffled_once(spark, folder, no_broadcast):
    # Orders that come twice, lines without order, orders without lines, and nulls in keys and sort columns.
    lines = [(o, n, 7 * (o or 1) % 5, (o or 0) + (n or 0), float(-(n or 0)), None if n == 2 else 1.5, "A", "F") for o in [*range(1, 40), None] for n in (3, 1, 2, None)]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, names).repartition(3).write.parquet(f"{folder}/lineitem.parquet")
    orders = [(o, c, "O", "1-URGENT") for o in [*range(5, 60), None] for c in ((1, None) if o == 7 else (o,))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    ordered = X.lead_input(spark, folder, ordered=True)
    want = X.lead_input(spark, folder)
    assert rows(ordered) == rows(want) and ordered.count() == 4 * 35 + 4
    assert ordered.schema == want.schema
    place = lambda df: [(r.l_orderkey, r.l_linenumber) for r in df.collect()]
    assert place(ordered) == place(want.orderBy(*X.ORDER))
    assert plan(ordered).split("== Initial Plan ==")[0].count("Exchange ") == 1
