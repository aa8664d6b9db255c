from helpers import plan, rows
from pyspark.sql import functions as F

from sluice.operators.lookups import ReferenceList
from sluice.operators.rules import (
    Broken, Required, Unknown, accepted, all_present, any_null, classify, rejected, union_rejects,
)

SCHEMA = "n int, customer long, contact long, product long"


def leads(spark):
    return spark.createDataFrame(
        [
            (1, 10, 11, 5), (2, None, 11, 5), (3, 10, 11, None), (4, 99, 11, 5), (5, 10, 99, 5),
            (6, 10, 11, 9), (7, 99, 98, 9), (8, None, None, None),
        ],
        SCHEMA,
    )


def references(spark):
    parties = ReferenceList(spark.createDataFrame([(10,), (11,), (11,)], "id long"), "id")
    # One product in two languages.
    products = ReferenceList(spark.createDataFrame([(5, "US"), (5, "DE")], "id long, lang string"), "id")
    return parties, products


def reasons(df, name="reject_reason"):
    return {r["n"]: r[name] for r in df.collect()}


def test_first_broken_rule_gives_the_reason(spark):
    parties, products = references(spark)
    needed = Required(["customer", "contact"], "required")
    product_given = Required(["product"], "no product")
    customer = Unknown("customer", parties, "customer")
    contact = Unknown("contact", parties, "contact")
    product = Unknown("product", products, "product")
    fields_first = classify(leads(spark), [needed, product_given, customer, contact, product])
    assert reasons(fields_first) == {
        1: None, 2: "required", 3: "no product", 4: "customer", 5: "contact", 6: "product",
        7: "customer", 8: "required",
    }
    product_first = classify(leads(spark), [needed, product_given, product, customer, contact])
    assert reasons(product_first)[7] == "product"
    assert rows(accepted(fields_first)) == [(1, 10, 11, 5)]
    assert rejected(fields_first).count() == 7


def test_rows_are_neither_lost_nor_repeated(spark, no_broadcast):
    parties, products = references(spark)
    judged = classify(
        leads(spark), [Unknown("customer", parties, "c"), Unknown("contact", parties, "k"), Unknown("product", products, "p")]
    )
    assert sorted(reasons(judged)) == list(range(1, 9))
    assert judged.count() == 8


def test_sql_not_in_rule_passes_null(spark):
    parties, _ = references(spark)
    judged = reasons(classify(leads(spark), [Unknown("customer", parties, "c", sql_not_in=True)]))
    assert judged[2] is None and judged[4] == "c"
    assert reasons(classify(leads(spark), [Unknown("customer", parties, "c")]))[2] == "c"


def test_one_lookup_per_column_and_list(spark):
    parties, _ = references(spark)
    judged = classify(
        leads(spark),
        [Broken(F.col("n") > 100, "n"), Unknown("customer", parties, "a"), Unknown("customer", parties, "b")],
    )
    assert plan(judged).count("Join") == 1


def test_conditions_and_union(spark):
    df = leads(spark)
    assert df.filter(any_null(["customer", "product"])).count() == 3
    assert df.filter(all_present(["customer", "product"])).count() == 5
    both = union_rejects([df.select("n", "customer"), df.select("n", F.lit("late").alias("reason"))])
    assert both.columns == ["n", "customer", "reason"]
    assert both.count() == 16
