"""Lead-shaped frames over the given tables, and the same in SQL for the checks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sluice import schemas
from sluice.operators.lookups import ReferenceList
from sluice.operators.numbering import dense_number
from sluice.operators.rules import accepted, classify
from sluice.plans import leads as L
from sluice.scratch import materialize, scratch_path

# Fixed value: the time that loads are stamped with.
STAMP = "01-JAN-06 12.00.00.000000000 AM"
BATCH = 4711
# These six identify a line item.
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
FIELDS = [f for f in schemas.LEAD_FILE.fieldNames() if f != schemas.CORRUPT]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lead_source(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """Line items with their order, as they are in the tables; ``ordered``: in the order of ``ORDER``."""
    lines = table(spark, sf_dir, "lineitem").select(*ORDER, "l_returnflag", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    if not ordered:
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    # A join and then a sort would shuffle the lines twice. Ranges of the key bring a line and its orders
    # together and are in order already; in a range the orders of a key stand before its lines.
    key, order = ORDER[0], F.col("__order")
    orders = orders.select(F.col("o_orderkey").alias(key), F.struct(*orders.columns).alias("__order"))
    both = lines.unionByName(orders, allowMissingColumns=True).filter(F.col(key).isNotNull()).repartitionByRange(key)
    of_key = Window.partitionBy(key).orderBy(order.isNull(), *ORDER[1:])
    whole = of_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = both.withColumn("__orders", F.collect_list(order).over(whole)).filter(order.isNull())
    return found.select(*lines.columns, F.inline("__orders"))


def lead_fields() -> dict[str, Column]:
    """The fields of a lead file row from the columns of ``lead_source``, with nulls in required fields."""
    c = F.col
    return {
        "leadNumber": F.when(c("l_partkey") % 41 != 0, F.concat(F.lit("L"), "l_orderkey")),
        "customerId": c("o_custkey"),
        "primaryContactId": F.when(c("l_suppkey") % 29 != 3, c("l_suppkey")),
        "leadName": F.concat(F.lit("Lead "), "l_orderkey", F.lit("-"), "l_linenumber"),
        "dealSize": F.floor("l_quantity").cast("int"),
        "city": F.when(c("l_suppkey") % 5 == 0, F.concat(F.lit("Port "), c("l_suppkey") % 50, F.lit(", North")))
        .otherwise(F.concat(F.lit("City "), c("l_suppkey") % 50)),
        "state": c("o_orderstatus"),
        "Country": F.when(c("o_custkey") % 7 != 0, F.lit("US")),
        "PartyUsageCode": F.when(~((c("l_linenumber") == 7) & (c("l_suppkey") % 2 == 0)), c("l_returnflag")),
        "PartyRole": c("l_linestatus"),
        "productGroupId": F.when(c("l_partkey") % 37 != 0, c("l_partkey")),
        "currCode": c("o_orderpriority"),
        "BudgetAmount": (c("l_linenumber") * 10).cast("int"),
    }


def lead_input(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """Line items with their order as lead file rows."""
    joined = lead_source(spark, sf_dir, ordered)
    return joined.select(*[value.alias(name) for name, value in lead_fields().items()], *ORDER)


def parties(spark: SparkSession, sf_dir: str) -> ReferenceList:
    customer = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'")
    return ReferenceList(customer.select(F.col("c_custkey").alias("party_id")), "party_id")


def products(spark: SparkSession, sf_dir: str) -> ReferenceList:
    part = table(spark, sf_dir, "part").filter("p_size <= 40")
    return ReferenceList(part.select(F.col("p_partkey").alias("prod_group_id")), "prod_group_id")


def existing_leads(spark: SparkSession, sf_dir: str) -> ReferenceList:
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return ReferenceList(done.select(F.concat(F.lit("L"), "o_orderkey").alias("lead_number")), "lead_number")


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = L.intake_rules(parties(spark, sf_dir), products(spark, sf_dir))
    return classify(lead_input(spark, sf_dir), rules)


def checked_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads that pass every rule."""
    return accepted(classified(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows of the leads whose required fields are there, numbered in line item order."""
    fields = lead_fields()
    valid = reduce(and_, [fields[c].isNotNull() for c in [*L.REQUIRED, "productGroupId"]])
    # The columns of the tables are ordered, which take less than the fields made of them.
    numbered = dense_number(lead_source(spark, sf_dir).filter(valid), ORDER, "FILE_RECORD_NUM", cheap=True)
    numbered = numbered.select("FILE_RECORD_NUM", *[value.alias(name) for name, value in fields.items()])
    return L.stage_rows(numbered, schemas.LEAD_FILE_WIDE, BATCH, STAMP, "PLSQL")


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = ReferenceList(
        table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_orderkey"), "o_orderkey"
    )
    rules = L.staged_rules(parties(spark, sf_dir), products(spark, sf_dir))
    return materialize(L.import_status(staged(spark, sf_dir), BATCH, rules, ids), "status")


L_VALID = " AND ".join(f"{c} IS NOT NULL" for c in [*L.REQUIRED, "productGroupId"])
HEADER = ",".join(FIELDS)


def lead_lines(df: DataFrame) -> DataFrame:
    """Lead rows as CSV text with some malformed lines; ``df`` keeps the line item columns."""
    quoted = {"city": F.concat(F.lit('"'), "city", F.lit('"'))}
    deal = F.when(F.col("l_partkey") % 53 == 0, "xx").otherwise(F.col("dealSize").cast("string"))
    quoted["dealSize"] = deal
    text = [F.coalesce(quoted.get(f, F.col(f)).cast("string"), F.lit("")) for f in FIELDS]
    whole = F.concat_ws(",", *text)
    line = (
        F.when(F.col("l_partkey") % 53 == 0, whole)
        .when(F.col("l_partkey") % 59 == 0, F.concat_ws(",", *text[:-1]))
        .when(F.col("l_partkey") % 61 == 0, F.concat(whole, F.lit(",extra")))
        .otherwise(whole)
    )
    return df.withColumn("line", line)


def write_lines(lines: DataFrame, header: str, path: str) -> None:
    """Ready-made CSV lines below a header; a separator that occurs nowhere leaves them as they are."""
    (
        lines.select(F.col("line").alias(header))
        .write.option("header", True)
        .option("sep", "\u0001")
        .option("quote", "\u0000")
        .option("escape", "\u0000")
        .csv(path)
    )


def lead_file(spark: SparkSession, sf_dir: str) -> str:
    """The lead rows written as a CSV file in line item order."""
    path = scratch_path(spark, "lead-file")
    write_lines(lead_lines(lead_input(spark, sf_dir, ordered=True)), HEADER, path)
    return path


LEADS_SQL = """
WITH leads AS (
  SELECT CASE WHEN l_partkey % 41 <> 0 THEN 'L' || l_orderkey END AS "leadNumber",
         o_custkey AS "customerId",
         CASE WHEN l_suppkey % 29 <> 3 THEN l_suppkey END AS "primaryContactId",
         'Lead ' || l_orderkey || '-' || l_linenumber AS "leadName",
         CAST(floor(l_quantity) AS INTEGER) AS "dealSize",
         CASE WHEN l_suppkey % 5 = 0 THEN 'Port ' || (l_suppkey % 50) || ', North'
              ELSE 'City ' || (l_suppkey % 50) END AS "city",
         o_orderstatus AS "state",
         CASE WHEN o_custkey % 7 <> 0 THEN 'US' END AS "Country",
         CASE WHEN NOT (l_linenumber = 7 AND l_suppkey % 2 = 0) THEN l_returnflag END AS "PartyUsageCode",
         l_linestatus AS "PartyRole",
         CASE WHEN l_partkey % 37 <> 0 THEN l_partkey END AS "productGroupId",
         o_orderpriority AS "currCode",
         CAST(l_linenumber * 10 AS INTEGER) AS "BudgetAmount",
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
parties AS (SELECT c_custkey AS party_id FROM customer WHERE c_mktsegment <> 'MACHINERY'),
products AS (SELECT p_partkey AS prod_group_id FROM part WHERE p_size <= 40),
existing AS (SELECT 'L' || o_orderkey AS lead_number FROM orders WHERE o_orderstatus = 'F'),
judged AS (
  SELECT *, CASE
    WHEN "leadNumber" IS NULL OR "customerId" IS NULL OR "primaryContactId" IS NULL
      OR "leadName" IS NULL OR "PartyUsageCode" IS NULL THEN 'missing_required'
    WHEN "productGroupId" IS NULL THEN 'missing_product_group'
    WHEN "customerId" NOT IN (SELECT party_id FROM parties) THEN 'unknown_customer'
    WHEN "primaryContactId" NOT IN (SELECT party_id FROM parties) THEN 'unknown_contact'
    WHEN "productGroupId" NOT IN (SELECT prod_group_id FROM products) THEN 'unknown_product'
    END AS reject_reason
  FROM leads),
valid AS (SELECT * EXCLUDE (reject_reason) FROM judged
  WHERE reject_reason IS NULL OR reject_reason NOT LIKE 'missing%'),
checked AS (SELECT * EXCLUDE (reject_reason) FROM judged WHERE reject_reason IS NULL),
inserts AS (SELECT * FROM checked WHERE "leadNumber" NOT IN (SELECT lead_number FROM existing)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "leadNumber" ORDER BY l_orderkey, l_linenumber,
    l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM inserts),
staged AS (
  SELECT "leadNumber" AS ATTRIBUTE_SMALL_CHAR002, CAST("customerId" AS VARCHAR) AS ATTRIBUTE_SMALL_CHAR003,
         CAST("primaryContactId" AS VARCHAR) AS ATTRIBUTE_SMALL_CHAR004, "leadName" AS ATTRIBUTE_SMALL_CHAR005,
         CAST("dealSize" AS VARCHAR) AS ATTRIBUTE_SMALL_CHAR006, "city" AS ATTRIBUTE_SMALL_CHAR007,
         "state" AS ATTRIBUTE_SMALL_CHAR008, "Country" AS ATTRIBUTE_SMALL_CHAR009,
         CAST("BudgetAmount" AS VARCHAR) AS ATTRIBUTE_SMALL_CHAR010,
         "PartyUsageCode" AS ATTRIBUTE_SMALL_CHAR011, "PartyRole" AS ATTRIBUTE_SMALL_CHAR012,
         CAST("productGroupId" AS VARCHAR) AS ATTRIBUTE_SMALL_CHAR013, "currCode" AS ATTRIBUTE_SMALL_CHAR014,
         n AS FILE_RECORD_NUM, n AS INTERFACE_ROW_ID, n AS PK1,
         TIMESTAMP '2006-01-01 00:00:00' AS CREATION_DATE, TIMESTAMP '2006-01-01 00:00:00' AS LAST_UPDATE_DATE,
         'PLSQL' AS CREATED_BY, 'PLSQL' AS LAST_UPDATED_BY, CAST(4711 AS INTEGER) AS BATCH_ID
  FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
          l_extendedprice) AS n FROM valid)),
status AS (
  SELECT *, CASE WHEN ERROR_MESSAGE IS NULL THEN 'I' ELSE 'E' END AS IMPORT_STATUS_CODE,
         CASE WHEN PK1 IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') THEN 'U' END AS IMPORT_MODE
  FROM (SELECT *, CASE
      WHEN ATTRIBUTE_SMALL_CHAR013 NOT IN (SELECT CAST(prod_group_id AS VARCHAR) FROM products)
        THEN 'Invalid Product (PROD_GROUP_ID)'
      WHEN ATTRIBUTE_SMALL_CHAR003 NOT IN (SELECT CAST(party_id AS VARCHAR) FROM parties)
        THEN 'Invalid Customer (CUSTOMER_ID)'
      WHEN ATTRIBUTE_SMALL_CHAR004 NOT IN (SELECT CAST(party_id AS VARCHAR) FROM parties)
        THEN 'Invalid Contact (PRIMARY_CONTACT_ID)' END AS ERROR_MESSAGE
    FROM staged)),
lines AS (
  SELECT *, CASE WHEN l_partkey % 53 = 0 THEN whole WHEN l_partkey % 59 = 0 THEN short
                 WHEN l_partkey % 61 = 0 THEN whole || ',extra' ELSE whole END AS line,
         l_partkey % 53 = 0 OR l_partkey % 59 = 0 OR l_partkey % 61 = 0 AS bad
  FROM (SELECT *, short || ',' || "BudgetAmount" AS whole
    FROM (SELECT *, coalesce("leadNumber", '') || ',' || "customerId" || ','
      || coalesce(CAST("primaryContactId" AS VARCHAR), '') || ',' || "leadName" || ','
      || CASE WHEN l_partkey % 53 = 0 THEN 'xx' ELSE CAST("dealSize" AS VARCHAR) END || ',"' || "city" || '",'
      || "state" || ',' || coalesce("Country", '') || ',' || coalesce("PartyUsageCode", '') || ','
      || "PartyRole" || ',' || coalesce(CAST("productGroupId" AS VARCHAR), '') || ',' || "currCode" AS short
      FROM leads)))
"""
