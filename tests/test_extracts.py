"""Extracts that are brought up to date, and types found in one pass."""

from datetime import datetime, timedelta

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from sluice.sinks.store import Store, Transaction
from sluice.sources.delimited import narrowest_types, read_delimited
from sluice.sources.extracts import refresh_extract

DAY = datetime(2020, 1, 1)


def source(spark, changes):
    """(key, day of the last change, value)."""
    return spark.createDataFrame([(k, None if d is None else DAY + timedelta(days=d), v) for k, d, v in changes], "k long, at timestamp_ntz, v string")


def test_refresh_equals_a_new_extract(spark, folder, monkeypatch):
    old = [(k, k % 30, f"v{k}") for k in range(200)] + [(None, 5, "no key"), (900, None, "no time")]
    new = [(k, 40 if k % 9 == 0 else d, "moved" if k % 9 == 0 else v) for k, d, v in old if k is not None] + [(300, 39, "new"), (301, 70, "later")]
    steps = [(old, 30), (new, 45), (new, 45), (new, 80)]
    store = Store(spark, f"{folder}/store")
    for n, (content, day) in enumerate(steps):
        arguments = ("k", "at"), {"days": 25, "as_of": DAY + timedelta(days=day), "keep": F.col("v") != "v7"}
        got = refresh_extract(store, "x", source(spark, content).repartitionByRange(8, "k"), *arguments[0], **arguments[1])
        want = refresh_extract(Store(spark, f"{folder}/whole{n}"), "x", source(spark, content), *arguments[0], **arguments[1])
        assert rows(got) == rows(want)
        assert {r.k for r in got.collect()} == {k for k, d, v in content if k is not None and d is not None and day - 25 < d <= day and v != "v7"}


def test_a_refresh_that_breaks_off_is_done_again(spark, folder, monkeypatch):
    store = Store(spark, f"{folder}/store")
    run = lambda rows, day: refresh_extract(store, "x", source(spark, rows), "k", "at", days=100, as_of=DAY + timedelta(days=day))
    run([(1, 1, "a"), (2, 1, "b")], 5)
    with monkeypatch.context() as m:
        m.setattr(Transaction, "commit", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run([(1, 6, "c"), (2, 1, "b")], 10)
    assert {r.v for r in store.read("x").collect()} == {"a", "b"} and store.begin().mark("x") == (DAY + timedelta(days=5)).isoformat()
    assert {r.v for r in run([(1, 6, "c"), (2, 1, "b")], 10).collect()} == {"c", "b"}


def test_types_of_one_pass(spark, folder):
    with open(f"{folder}/a.csv", "w") as out:
        out.write("i,l,d,b,t,s,last,e,x.y\n")
        for k in range(50):
            out.write(f"{k},{k + 3_000_000_000},{k}.5,{'TRUE' if k % 2 else 'false'},2020-01-{k % 28 + 1:02d} 10:00:00,t{k},{k},,-{k}\n")
        out.write(",,1e3,,2020-01-01,,3.5x,,\n")
    got = read_delimited(spark, f"{folder}/a.csv", infer=True)
    assert dict(got.dtypes) == {"i": "int", "l": "bigint", "d": "double", "b": "boolean", "t": "timestamp_ntz", "s": "string", "last": "string", "e": "string", "x.y": "int"}
    last = got.filter("last = '3.5x'").first()
    assert last.d == 1000.0 and last.t == datetime(2020, 1, 1) and last.i is None and got.count() == 51
    # The file was read once, when it was stored as text.
    assert "Scan csv" not in plan(got)
    assert narrowest_types(spark.createDataFrame([], "a string")) == {"a": "string"}
