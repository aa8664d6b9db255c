"""One query per operator over the given tables, each next to SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice import schemas
from sluice.functions.stamp import as_text, audit, batch, rename, sequence_id, surrogate_id
from sluice.operators import changes, rules
from sluice.operators.lookups import ReferenceList, flag_not_in, in_reference, not_in_reference
from sluice.operators.numbering import dense_number
from sluice.operators.upsert import delete_where, merge_rows, upsert
from sluice.plans import jobs, leads as L
from sluice.scratch import materialize, scratch_path
from sluice.sinks.files import committed_run, create_csv, write_csv
from sluice.sinks.store import Store
from sluice.sinks.tables import append, drop_old_versions, overwrite_partitions, publish, touched
from sluice.sources.delimited import malformed, physical_lines, read_delimited, store_delimited
from sluice.sources.extracts import cached_extract, key_extract, refresh_extract, younger_than
from workload import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

LEAD = [*X.FIELDS, "l_orderkey", "l_linenumber"]
LEAD_SQL = ", ".join(f'"{c}"' for c in LEAD)


def query(sql: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        ORACLE[build.__name__] = sql
        return build

    return register


def on_leads(select: str) -> str:
    return X.LEADS_SQL + select


# --- files -----------------------------------------------------------------------------------

_PARSED = """
SELECT "leadNumber", "customerId", "primaryContactId", "leadName",
       CASE WHEN l_partkey % 53 <> 0 THEN "dealSize" END AS "dealSize", "city", "state", "Country",
       "PartyUsageCode", "PartyRole", "productGroupId", "currCode",
       CASE WHEN l_partkey % 53 = 0 OR l_partkey % 59 <> 0 THEN "BudgetAmount" END AS "BudgetAmount",
       CASE WHEN bad THEN line END AS "_corrupt_record",
       row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         l_extendedprice) AS "FILE_RECORD_NUM" FROM lines
"""


@query(on_leads(_PARSED))
def csv_permissive(spark, sf_dir):
    return store_delimited(spark, X.lead_file(spark, sf_dir), schemas.LEAD_FILE)


@query(on_leads('SELECT "_corrupt_record", "FILE_RECORD_NUM" FROM (' + _PARSED + ') WHERE "_corrupt_record" IS NOT NULL'))
def csv_quarantine(spark, sf_dir):
    stored = store_delimited(spark, X.lead_file(spark, sf_dir), schemas.LEAD_FILE)
    return malformed(stored).select(schemas.CORRUPT, "FILE_RECORD_NUM")


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, 'Firm, ' || c_name AS c_name, "
       "CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def csv_strings(spark, sf_dir):
    path = scratch_path(spark, "customer-file")
    customer = X.table(spark, sf_dir, "customer")
    write_csv(customer.select("c_custkey", F.concat(F.lit("Firm, "), "c_name").alias("c_name"), "c_nationkey"), path)
    return read_delimited(spark, path)


@query("SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_size, p_retailprice FROM part")
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "part-file")
    write_csv(X.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), path)
    return read_delimited(spark, path, infer=True)


@query("SELECT count(*) + count(CASE WHEN c_custkey % 10 = 0 THEN 1 END) AS lines FROM customer")
def physical_line_count(spark, sf_dir):
    path = scratch_path(spark, "customer-lines")
    name = F.when(F.col("c_custkey") % 10 == 0, F.concat("c_name", F.lit("\nsecond line"))).otherwise(F.col("c_name"))
    X.table(spark, sf_dir, "customer").select("c_custkey", name.alias("c_name")).write.csv(path)
    return spark.range(1).select(F.lit(physical_lines(spark, path)).alias("lines"))


@query("SELECT CAST(o_custkey AS VARCHAR) AS party_id FROM orders WHERE o_orderstatus LIKE 'F' "
       "AND o_orderdate > TIMESTAMP '2001-01-01 00:00:00' - INTERVAL 1000 DAY")
def extract_cache(spark, sf_dir):
    path = scratch_path(spark, "party-extract")
    recent = F.col("o_orderstatus").like("F") & younger_than("o_orderdate", 1000, datetime(2001, 1, 1))

    def build():
        return key_extract(X.table(spark, sf_dir, "orders"), "o_custkey", "party_id", recent)

    cached_extract(spark, path, build)
    return cached_extract(spark, path, build)


@query("SELECT s_suppkey, s_name FROM supplier")
def overwrite_sink(spark, sf_dir):
    path = scratch_path(spark, "overwritten")
    supplier = X.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    write_csv(supplier.withColumn("s_name", F.reverse("s_name")), path)
    write_csv(supplier, path)
    return read_delimited(spark, path, supplier.schema)


@query("SELECT p_partkey, p_brand FROM part")
def create_only_sink(spark, sf_dir):
    path = scratch_path(spark, "created")
    part = X.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    create_csv(part, path)
    return read_delimited(spark, path, part.schema)


@query(on_leads(f"SELECT {LEAD_SQL}, reject_reason FROM judged WHERE reject_reason IS NOT NULL"))
def reject_sink(spark, sf_dir):
    path = scratch_path(spark, "rejects")
    rejects = rules.rejected(X.classified(spark, sf_dir)).select(*LEAD, "reject_reason")
    write_csv(rejects, path, by="reject_reason")
    return read_delimited(spark, path, rejects.schema)


# --- rules -----------------------------------------------------------------------------------


@query(on_leads(f"SELECT {LEAD_SQL} FROM judged WHERE reject_reason = 'missing_required'"))
def required_rejects(spark, sf_dir):
    return X.lead_input(spark, sf_dir).filter(rules.any_null(L.REQUIRED)).select(*LEAD)


@query(on_leads(f"SELECT {LEAD_SQL} FROM valid"))
def valid_rows(spark, sf_dir):
    return _valid(spark, sf_dir).select(*LEAD)


def _valid(spark, sf_dir):
    return X.lead_input(spark, sf_dir).filter(rules.all_present([*L.REQUIRED, "productGroupId"]))


def _customer_known(spark, sf_dir):
    return in_reference(_valid(spark, sf_dir), "customerId", X.parties(spark, sf_dir))


def _contact_known(spark, sf_dir):
    return in_reference(_customer_known(spark, sf_dir), "primaryContactId", X.parties(spark, sf_dir))


def _exists(column: str, reference: str, key: str) -> str:
    return f'EXISTS (SELECT 1 FROM {reference} r WHERE r.{key} IS NOT DISTINCT FROM v."{column}")'


_CUSTOMER = _exists("customerId", "parties", "party_id")
_CONTACT = _exists("primaryContactId", "parties", "party_id")
_PRODUCT = _exists("productGroupId", "products", "prod_group_id")


@query(on_leads(f"SELECT {LEAD_SQL} FROM valid v WHERE {_CUSTOMER}"))
def customer_valid(spark, sf_dir):
    return _customer_known(spark, sf_dir).select(*LEAD)


@query(on_leads(f"SELECT {LEAD_SQL} FROM valid v WHERE NOT {_CUSTOMER}"))
def customer_invalid(spark, sf_dir):
    return not_in_reference(_valid(spark, sf_dir), "customerId", X.parties(spark, sf_dir)).select(*LEAD)


@query(on_leads(f"SELECT {LEAD_SQL} FROM valid v WHERE {_CUSTOMER} AND {_CONTACT}"))
def contact_valid(spark, sf_dir):
    return _contact_known(spark, sf_dir).select(*LEAD)


@query(on_leads(f"SELECT {LEAD_SQL} FROM valid v WHERE {_CUSTOMER} AND NOT {_CONTACT}"))
def contact_invalid(spark, sf_dir):
    known = _customer_known(spark, sf_dir)
    return not_in_reference(known, "primaryContactId", X.parties(spark, sf_dir)).select(*LEAD)


@query(on_leads(f"SELECT {LEAD_SQL} FROM valid v WHERE {_CUSTOMER} AND {_CONTACT} AND {_PRODUCT}"))
def product_valid(spark, sf_dir):
    known = _contact_known(spark, sf_dir)
    return in_reference(known, "productGroupId", X.products(spark, sf_dir)).select(*LEAD)


@query(on_leads(f"SELECT {LEAD_SQL} FROM valid v WHERE {_CUSTOMER} AND {_CONTACT} AND NOT {_PRODUCT}"))
def product_invalid(spark, sf_dir):
    known = _contact_known(spark, sf_dir)
    return not_in_reference(known, "productGroupId", X.products(spark, sf_dir)).select(*LEAD)


@query(on_leads("SELECT reject_reason, count(*) AS n FROM judged WHERE reject_reason IS NOT NULL GROUP BY reject_reason"))
def rejects_by_reason(spark, sf_dir):
    return changes.class_counts(rules.rejected(X.classified(spark, sf_dir)), "reject_reason")


@query(on_leads(
    "SELECT ERROR_MESSAGE, count(*) AS n FROM status WHERE ERROR_MESSAGE IS NOT NULL GROUP BY ERROR_MESSAGE"
))
def rejects_by_reason_staged(spark, sf_dir):
    return changes.class_counts(rules.rejected(X.status(spark, sf_dir), "ERROR_MESSAGE"), "ERROR_MESSAGE")


@query(on_leads(f"SELECT {LEAD_SQL}, reject_reason FROM judged WHERE reject_reason = 'unknown_customer' "
                f"UNION ALL SELECT {LEAD_SQL}, NULL FROM judged WHERE reject_reason = 'missing_required'"))
def union_of_rejects(spark, sf_dir):
    unknown = X.classified(spark, sf_dir).filter("reject_reason = 'unknown_customer'").select(*LEAD, "reject_reason")
    missing = X.lead_input(spark, sf_dir).filter(rules.any_null(L.REQUIRED)).select(*LEAD)
    return rules.union_rejects([unknown, missing])


def _lists(spark, sf_dir):
    part = X.table(spark, sf_dir, "part").filter("p_size <= 40")
    plain = ReferenceList(part.select("p_partkey"), "p_partkey")
    holed = part.select(F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey")).alias("k"))
    return plain, ReferenceList(holed, "k"), ReferenceList(part.filter("p_size < 0"), "p_partkey")


@query("""
WITH rows AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 37 <> 0 THEN l_partkey END AS k FROM lineitem),
good AS (SELECT p_partkey FROM part WHERE p_size <= 40)
SELECT l_orderkey, l_linenumber, k,
  coalesce(k NOT IN (SELECT p_partkey FROM good), false) AS missing,
  coalesce(k NOT IN (SELECT CASE WHEN p_partkey % 10 <> 0 THEN p_partkey END FROM good), false) AS missing_holed,
  coalesce(k NOT IN (SELECT p_partkey FROM good WHERE p_partkey < 0), false) AS missing_empty
FROM rows
""")
def not_in_nulls(spark, sf_dir):
    plain, holed, empty = _lists(spark, sf_dir)
    key = F.when(F.col("l_partkey") % 37 != 0, F.col("l_partkey")).alias("k")
    rows = X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", key)
    rows = flag_not_in(rows, "k", plain, "missing")
    rows = flag_not_in(rows, "k", holed, "missing_holed")
    return flag_not_in(rows, "k", empty, "missing_empty")


# --- changes ---------------------------------------------------------------------------------


def _changes(spark, sf_dir):
    existing = X.existing_leads(spark, sf_dir)
    return changes.flag_changes(X.checked_leads(spark, sf_dir), "leadNumber", existing)


def _inserts(spark, sf_dir):
    return _changes(spark, sf_dir).filter("change = 'insert'").drop("change")


def _first(spark, sf_dir):
    return changes.dedup(_inserts(spark, sf_dir), ["leadNumber"], X.ORDER)


@query(on_leads(f'SELECT {LEAD_SQL} FROM checked WHERE "leadNumber" IN (SELECT lead_number FROM existing)'))
def lead_updates(spark, sf_dir):
    return _changes(spark, sf_dir).filter("change = 'update'").select(*LEAD)


@query(on_leads(f"SELECT {LEAD_SQL} FROM inserts"))
def lead_inserts(spark, sf_dir):
    return _inserts(spark, sf_dir).select(*LEAD)


@query(on_leads(f"SELECT {LEAD_SQL} FROM ranked WHERE rn = 1"))
def dedup_leads(spark, sf_dir):
    return _first(spark, sf_dir).select(*LEAD)


@query(on_leads(f"SELECT {LEAD_SQL} FROM ranked WHERE rn > 1"))
def dropped_duplicates(spark, sf_dir):
    inserts = materialize(_inserts(spark, sf_dir), "inserts")
    first = changes.dedup(inserts.select("leadNumber", *X.ORDER), ["leadNumber"], X.ORDER)
    return changes.dropped_duplicates(inserts, first, ["leadNumber"], X.ORDER).select(*LEAD)


@query("SELECT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def set_difference(spark, sf_dir):
    done = X.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    return changes.set_difference(X.table(spark, sf_dir, "lineitem").select("l_orderkey"), done)


@query(on_leads("""
SELECT count(CASE WHEN p > 0 THEN 1 END) AS outperformed, count(CASE WHEN p = 0 THEN 1 END) AS met,
       count(CASE WHEN p < 0 THEN 1 END) AS underperformed
FROM (SELECT CAST("BudgetAmount" AS BIGINT) - "dealSize" AS p FROM inserts)
"""))
def deal_buckets(spark, sf_dir):
    performance = changes.deal_performance("BudgetAmount", "dealSize")
    return changes.deal_buckets(_inserts(spark, sf_dir).withColumn("p", performance), "p")


@query(on_leads(
    'SELECT CAST(sum("dealSize") AS BIGINT) AS total_deal_size, CAST(sum("BudgetAmount") AS BIGINT) AS total_budget '
    "FROM ranked WHERE rn = 1"
))
def deal_totals(spark, sf_dir):
    return changes.deal_totals(_first(spark, sf_dir), "dealSize", "BudgetAmount")


# --- projections and stamps ------------------------------------------------------------------

_STAMPED = """TIMESTAMP '2006-01-01 00:00:00' AS CREATION_DATE, TIMESTAMP '2006-01-01 00:00:00' AS LAST_UPDATE_DATE,
'GS1' AS CREATED_BY, 'GS1' AS LAST_UPDATED_BY"""


@query(f"SELECT c_custkey AS PARTY_ID, c_name AS ORGANIZATION_NAME, {_STAMPED}, CAST(4711 AS INTEGER) AS BATCH_ID FROM customer")
def audit_batch_stamp(spark, sf_dir):
    renamed = rename(X.table(spark, sf_dir, "customer"), {"c_custkey": "PARTY_ID", "c_name": "ORGANIZATION_NAME"})
    return batch(audit(renamed, X.STAMP, "GS1"), X.BATCH)


@query(on_leads('SELECT CAST("customerId" AS VARCHAR) AS "customerId", CAST("productGroupId" AS VARCHAR) AS "productGroupId" FROM leads'))
def number_to_text(spark, sf_dir):
    return as_text(X.lead_input(spark, sf_dir).select("customerId", "productGroupId"))


@query("SELECT count(*) AS n, count(*) AS n_ids, true AS offset_kept FROM lineitem")
def surrogate_ids(spark, sf_dir):
    numbered = surrogate_id(X.table(spark, sf_dir, "lineitem").select("l_orderkey"), "id", start=5000)
    return numbered.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("id").alias("n_ids"),
        (F.min("id") >= 5000).alias("offset_kept"),
    )


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN length(id) < 11 THEN lpad(id, 11, '0') ELSE id END AS id
FROM (SELECT *, CAST(99999999990 + row_number() OVER (ORDER BY o_custkey, o_orderkey) AS VARCHAR) AS id FROM orders)
""")
def dense_ids(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return sequence_id(orders, ["o_custkey", "o_orderkey"], "id", base=99_999_999_990, cheap=True)


@query("SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS n FROM orders")
def dense_ids_per_class(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return dense_number(orders, ["o_orderkey"], "n", within=["o_orderstatus"], cheap=True)


_WITH_ID = """(SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
l_extendedprice) AS "LEAD_ID" FROM ranked WHERE rn = 1)"""


def _with_id(spark, sf_dir):
    return dense_number(_first(spark, sf_dir), X.ORDER, "LEAD_ID")


@query(on_leads(f"""SELECT "LEAD_ID", "leadNumber" AS LEAD_NUMBER, "customerId" AS CUSTOMER_ID,
"primaryContactId" AS PRIMARY_CONTACT_ID, "leadName" AS LEAD_NAME, "dealSize" AS DEAL_SIZE, city AS CITY, state AS STATE,
"BudgetAmount" AS BUDGET_AMOUNT, {_STAMPED} FROM {_WITH_ID}"""))
def standardised_leads(spark, sf_dir):
    return L.standardise_leads(_with_id(spark, sf_dir), X.STAMP, "GS1")


@query(on_leads(f"""SELECT "LEAD_ID", "PartyUsageCode" AS PARTY_USAGE_CODE, "primaryContactId" AS PARTY_ID,
"PartyRole" AS PARTY_ROLE, CAST("LEAD_ID" AS VARCHAR) AS MKL_LEAD_TC_MEMBER_ID, {_STAMPED} FROM {_WITH_ID}"""))
def standardised_members(spark, sf_dir):
    return L.standardise_members(_with_id(spark, sf_dir), X.STAMP, "GS1")


@query(on_leads(f"""SELECT "LEAD_ID", "productGroupId" AS PRODUCT_GROUP_ID, "currCode" AS CONV_CURR_CODE,
CAST("LEAD_ID" AS VARCHAR) AS PROD_ASSOC_ID, {_STAMPED} FROM {_WITH_ID}"""))
def standardised_items(spark, sf_dir):
    return L.standardise_items(_with_id(spark, sf_dir), X.STAMP, "GS1")


@query("SELECT o_custkey AS CUSTOMER_ID, o_totalprice AS AMOUNT FROM orders WHERE o_orderstatus LIKE 'F'")
def sql_text_entry(spark, sf_dir):
    return spark.sql(
        "SELECT o_custkey AS CUSTOMER_ID, o_totalprice AS AMOUNT FROM {orders} WHERE o_orderstatus LIKE 'F'",
        orders=X.table(spark, sf_dir, "orders"),
    )


# --- upsert and merge ------------------------------------------------------------------------


def _target(spark, sf_dir):
    return X.table(spark, sf_dir, "orders").filter("o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'")


def _source(spark, sf_dir):
    late = "o_orderdate >= TIMESTAMP_NTZ '1999-01-01 00:00:00' OR o_orderpriority = '1-URGENT'"
    return X.table(spark, sf_dir, "orders").filter(late).withColumn("o_totalprice", F.col("o_totalprice") + 1)


_TABLES = """
WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
source AS (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders
  WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' OR o_orderpriority = '1-URGENT')
"""


@query(_TABLES + """
SELECT t.o_orderkey, t.o_custkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
  t.o_orderdate, t.o_orderpriority
FROM target t LEFT JOIN source s ON t.o_orderkey = s.o_orderkey
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL FROM source s
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = s.o_orderkey)
""")
def upsert_orders(spark, sf_dir):
    return upsert(
        _target(spark, sf_dir), _source(spark, sf_dir), ["o_orderkey"], ["o_orderstatus", "o_totalprice"],
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"],
    )


@query(_TABLES + """
, last AS (SELECT l_orderkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem)
  WHERE rn = 1)
SELECT o_orderkey, o_custkey, o_orderstatus, coalesce(l_extendedprice, o_totalprice) AS o_totalprice, o_orderdate, o_orderpriority
FROM target LEFT JOIN last ON l_orderkey = o_orderkey
UNION ALL
SELECT l_orderkey, NULL, NULL, l_extendedprice, NULL, NULL FROM last
WHERE NOT EXISTS (SELECT 1 FROM target WHERE o_orderkey = l_orderkey)
""")
def upsert_last_wins(spark, sf_dir):
    lines = X.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("o_totalprice"), *X.ORDER[1:]
    )
    return upsert(
        _target(spark, sf_dir), lines, ["o_orderkey"], ["o_totalprice"], ["o_orderkey", "o_totalprice"],
        order_by=X.ORDER[1:],
    )


@query(_TABLES + """
, judged AS (SELECT *, o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY') AS ok FROM source)
SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, CASE WHEN s.ok THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
  t.o_orderdate, t.o_orderpriority
FROM target t LEFT JOIN judged s ON t.o_orderkey = s.o_orderkey
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM judged s
WHERE ok AND NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = s.o_orderkey)
""")
def merge_conditional(spark, sf_dir):
    target = _target(spark, sf_dir)
    source = rules.classify(
        _source(spark, sf_dir), [rules.Unknown("o_custkey", X.parties(spark, sf_dir), "E")], "status"
    )
    source = changes.flag_changes(source, "o_orderkey", ReferenceList(target, "o_orderkey"), "mode")
    source = materialize(source, "merge-source")
    good = F.col("status").isNull()
    return merge_rows(
        target, source, [("o_orderkey", "o_orderkey")], {"o_totalprice": "o_totalprice"},
        {c: c for c in target.columns},
        matched_when=good & (F.col("mode") == "update"), insert_when=good,
    )


@query("SELECT * FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 100000)")
def delete_rows(spark, sf_dir):
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)
    return delete_where(X.table(spark, sf_dir, "orders"), gone)


@query("""
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal >= 3000 AND s_nationkey >= 12
UNION ALL SELECT s_suppkey, s_name || ', second', s_nationkey, s_acctbal FROM supplier
  WHERE s_acctbal >= 3000 AND s_nationkey < 12
UNION ALL SELECT s_suppkey, s_name || ', second', NULL, NULL FROM supplier WHERE s_acctbal < 3000 AND s_nationkey < 12
""")
def direct_upsert_file(spark, sf_dir):
    supplier = X.table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "supplier-file")
    twice = supplier.filter("s_nationkey < 12").select(
        "s_suppkey", "s_name", F.explode(F.array(F.lit("first"), F.lit("second"))).alias("turn")
    )
    named = twice.select("s_suppkey", F.concat("s_name", F.lit(", "), "turn").alias("s_name"), "turn")
    write_csv(named.orderBy("turn", "s_suppkey").drop("turn"), path)
    rows = store_delimited(spark, path, supplier.select("s_suppkey", "s_name").schema)
    return upsert(
        supplier.filter("s_acctbal >= 3000"), rows, ["s_suppkey"], ["s_name"], ["s_suppkey", "s_name"],
        order_by=["FILE_RECORD_NUM"],
    )


@query(f"""SELECT CAST(c_custkey AS VARCHAR) AS PARTY_NUMBER, c_name AS ORGANIZATION_NAME,
CAST(c_nationkey AS VARCHAR) AS COUNTRY, c_mktsegment AS INDUSTRY_CODE, {_STAMPED} FROM customer""")
def party_upload(spark, sf_dir):
    path = scratch_path(spark, "party-file")
    names = {"c_custkey": "PARTY_NUMBER", "c_name": "ORGANIZATION_NAME", "c_nationkey": "COUNTRY", "c_mktsegment": "INDUSTRY_CODE"}
    write_csv(rename(X.table(spark, sf_dir, "customer"), names), path)
    same = {n: n for n in schemas.PARTY_RENAMES if n in names.values()}
    rows = jobs.reference_rows(
        read_delimited(spark, path), same, at=X.STAMP, by="GS1", id_column="PARTY_ID", id_start=100
    )
    return rows.drop("PARTY_ID")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS PROD_GROUP_ID, 'US' AS LANGUAGE, 'US' AS SOURCE_LANG,
p_name AS PROD_GROUP_NAME, p_brand AS ADMIN_PROD_GRP_NAME, TIMESTAMP '2021-01-01 00:00:00' AS CREATION_DATE,
TIMESTAMP '2021-01-01 00:00:00' AS LAST_UPDATE_DATE, 'GS1' AS CREATED_BY, 'GS1' AS LAST_UPDATED_BY FROM part""")
def product_upload(spark, sf_dir):
    path = scratch_path(spark, "product-file")
    part = X.table(spark, sf_dir, "part")
    write_csv(
        part.select(
            F.col("p_partkey").alias("ProdGroupId"), F.lit("US").alias("Language"), F.lit("US").alias("SourceLang"),
            F.col("p_name").alias("ProdGroupName"), F.col("p_brand").alias("AdminProdGroupName"),
        ),
        path,
    )
    return jobs.reference_rows(
        read_delimited(spark, path), schemas.PRODUCT_RENAMES, at="01-JAN-21 12.00.00.000000000 AM", by="GS1"
    )


# --- staged intake ---------------------------------------------------------------------------


@query(on_leads("SELECT * FROM staged"))
def staging_rows(spark, sf_dir):
    return X.staged(spark, sf_dir)


@query(on_leads("SELECT FILE_RECORD_NUM, ERROR_MESSAGE, IMPORT_STATUS_CODE, IMPORT_MODE FROM status"))
def import_status(spark, sf_dir):
    return X.status(spark, sf_dir).select("FILE_RECORD_NUM", "ERROR_MESSAGE", "IMPORT_STATUS_CODE", "IMPORT_MODE")


@query(on_leads("""
SELECT lpad(CAST(CASE ERROR_MESSAGE WHEN 'Invalid Product (PROD_GROUP_ID)' THEN 9000
    WHEN 'Invalid Customer (CUSTOMER_ID)' THEN 9100 ELSE 9200 END
  + row_number() OVER (PARTITION BY ERROR_MESSAGE ORDER BY FILE_RECORD_NUM) AS VARCHAR), 11, '0') AS ERROR_ID,
  BATCH_ID, FILE_RECORD_NUM, ERROR_MESSAGE FROM status WHERE ERROR_MESSAGE IS NOT NULL
"""))
def error_log(spark, sf_dir):
    return L.error_log(X.status(spark, sf_dir))


_CHILD = """lpad(CAST(1000 + row_number() OVER (ORDER BY FILE_RECORD_NUM) AS VARCHAR), 11, '0')"""
_CHILD_STAMPS = "CREATION_DATE, LAST_UPDATE_DATE, LAST_UPDATED_BY, CREATED_BY FROM status WHERE IMPORT_STATUS_CODE = 'I'"


@query(on_leads(f"""SELECT {_CHILD} AS MKL_LEAD_TC_MEMBER_ID, PK1 AS LEAD_ID, ATTRIBUTE_SMALL_CHAR011 AS PARTY_USAGE_CODE,
CAST(ATTRIBUTE_SMALL_CHAR004 AS BIGINT) AS PARTY_ID, ATTRIBUTE_SMALL_CHAR012 AS PARTY_ROLE, {_CHILD_STAMPS}"""))
def member_rows(spark, sf_dir):
    return L.member_rows(L.accepted_rows(X.status(spark, sf_dir)))


@query(on_leads(f"""SELECT {_CHILD} AS PROD_ASSOC_ID, PK1 AS LEAD_ID, CAST(ATTRIBUTE_SMALL_CHAR013 AS BIGINT) AS PRODUCT_GROUP_ID,
ATTRIBUTE_SMALL_CHAR014 AS CONV_CURR_CODE, {_CHILD_STAMPS}"""))
def item_rows(spark, sf_dir):
    return L.item_rows(L.accepted_rows(X.status(spark, sf_dir)))


@query(on_leads("""
SELECT CAST(INTERFACE_ROW_ID AS VARCHAR) AS INTERFACE_ROW_ID, CAST(BATCH_ID AS VARCHAR) AS BATCH_ID,
  CAST(FILE_RECORD_NUM AS VARCHAR) AS FILE_RECORD_NUM, CAST(PK1 AS VARCHAR) AS PK1, ATTRIBUTE_SMALL_CHAR002,
  CASE IMPORT_STATUS_CODE WHEN 'I' THEN 'S' ELSE IMPORT_STATUS_CODE END AS IMPORT_STATUS_CODE, IMPORT_MODE
FROM status
"""))
def status_report(spark, sf_dir):
    return L.status_report(L.finished(X.status(spark, sf_dir)))


def _lead_table(spark, sf_dir):
    """Existing leads made of orders: the id is the order key."""
    orders = X.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    null = F.lit(None)
    values = {
        "LEAD_ID": F.col("o_orderkey"), "LEAD_NUMBER": F.concat(F.lit("L"), "o_orderkey"),
        "CUSTOMER_ID": F.col("o_custkey"), "CREATION_DATE": F.col("o_orderdate"), "CREATED_BY": F.lit("OLD"),
    }
    return orders.select(
        *[values.get(f.name, null).cast(f.dataType).alias(f.name) for f in schemas.LEADS]
    )


@query(on_leads("""
, old AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'),
taken AS (SELECT * FROM status WHERE IMPORT_STATUS_CODE = 'I')
SELECT coalesce(o_orderkey, PK1) AS LEAD_ID,
  CASE WHEN o_orderkey IS NOT NULL THEN 'L' || o_orderkey ELSE ATTRIBUTE_SMALL_CHAR002 END AS LEAD_NUMBER,
  CASE WHEN PK1 IS NULL THEN o_custkey ELSE CAST(ATTRIBUTE_SMALL_CHAR003 AS BIGINT) END AS CUSTOMER_ID,
  CAST(ATTRIBUTE_SMALL_CHAR004 AS BIGINT) AS PRIMARY_CONTACT_ID, ATTRIBUTE_SMALL_CHAR005 AS LEAD_NAME,
  CAST(ATTRIBUTE_SMALL_CHAR006 AS INTEGER) AS DEAL_SIZE, ATTRIBUTE_SMALL_CHAR007 AS CITY,
  ATTRIBUTE_SMALL_CHAR008 AS STATE, ATTRIBUTE_SMALL_CHAR009 AS COUNTRY,
  CAST(ATTRIBUTE_SMALL_CHAR010 AS INTEGER) AS BUDGET_AMOUNT,
  CASE WHEN o_orderkey IS NOT NULL THEN o_orderdate ELSE CREATION_DATE END AS CREATION_DATE, LAST_UPDATE_DATE,
  CASE WHEN o_orderkey IS NOT NULL THEN 'OLD' ELSE CREATED_BY END AS CREATED_BY, LAST_UPDATED_BY
FROM old FULL JOIN taken ON o_orderkey = PK1
"""))
def staged_merge(spark, sf_dir):
    return L.merge_leads(_lead_table(spark, sf_dir), X.status(spark, sf_dir))


def _kept_tables(spark, store: bool = False):
    """Names of new tables, in the catalog or in a store of its own."""
    tag = uuid.uuid4().hex[:12]
    names = [f"{n}_{tag}" for n in ("leads", "members", "items", "staging", "errors")]
    return jobs.LeadTables(*names, store=Store(spark, scratch_path(spark, "store")) if store else None)


def _load_orders(spark, sf_dir, targets, batch_id, rows, label, **more):
    """Load orders as a wide lead file of one batch."""
    values = {
        "LeadNumber": F.concat(F.lit("L"), "o_orderkey"), "CustomerId": F.col("o_custkey"), "PrimaryContactId": F.col("o_custkey"),
        "LeadName": F.concat(F.lit(label), "o_orderkey"), "DealSize": F.lit(batch_id), "PartyUsageCode": F.col("o_orderstatus"),
        "productGroupId": F.col("o_orderkey") % 100 + 1, "Country": F.when(F.col("o_orderkey") % 4 != 0, "US"),
    }
    fields = [f for f in schemas.LEAD_FILE_WIDE.fieldNames() if f != schemas.CORRUPT]
    path = scratch_path(spark, "batch-file")
    write_csv(rows.select(*[values.get(f, F.lit("x") if f != "BudgetAmount" else F.lit(7)).alias(f) for f in fields]), path)
    return jobs.staged_intake(
        spark, path, scratch_path(spark, "batch-out"), X.parties(spark, sf_dir), X.products(spark, sf_dir), targets,
        at=X.STAMP, by="PLSQL", batch_id=batch_id, **more,
    )


def _two_batches(spark, sf_dir, store: bool = False):
    """Finished orders as a first lead file, then all orders as a second one."""
    orders = X.table(spark, sf_dir, "orders")
    targets = _kept_tables(spark, store)
    _load_orders(spark, sf_dir, targets, 1, orders.filter("o_orderstatus = 'F'"), "First ")
    _load_orders(spark, sf_dir, targets, 2, orders, "Second ")
    return targets


def _rows_of(spark, targets, table: str):
    name = getattr(targets, table)
    return targets.store.read(name) if targets.store else spark.table(name)


_TWO = """
WITH judged AS (
  SELECT *, o_orderkey % 100 + 1 IN (SELECT p_partkey FROM part WHERE p_size <= 40) AS product_ok,
    o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY') AS customer_ok FROM orders
)
"""


_TWO_LOADED = _TWO + """
SELECT 'L' || o_orderkey AS LEAD_NUMBER, 'Second ' || o_orderkey AS LEAD_NAME, o_custkey AS CUSTOMER_ID, 2 AS DEAL_SIZE,
  CASE o_orderstatus WHEN 'F' THEN 2 ELSE 1 END AS n_members, CASE o_orderstatus WHEN 'F' THEN 2 ELSE 1 END AS n_items
FROM judged WHERE product_ok AND customer_ok
"""


def _with_children(spark, targets):
    count = lambda table, name: _rows_of(spark, targets, table).groupBy("LEAD_ID").agg(F.count(F.lit(1)).alias(name))
    found = _rows_of(spark, targets, "leads").join(count("members", "n_members"), "LEAD_ID", "left").join(count("items", "n_items"), "LEAD_ID", "left")
    return found.select("LEAD_NUMBER", "LEAD_NAME", "CUSTOMER_ID", "DEAL_SIZE", "n_members", "n_items")


@query(_TWO_LOADED)
def staged_two_batches(spark, sf_dir):
    return _with_children(spark, _two_batches(spark, sf_dir))


@query(_TWO_LOADED)
def store_two_batches(spark, sf_dir):
    return _with_children(spark, _two_batches(spark, sf_dir, store=True))


def _replaced_batch(spark, sf_dir, store: bool):
    """A file of all orders and its correction: without every third order, and with valid products only, in another order."""
    orders = X.table(spark, sf_dir, "orders")
    targets = _kept_tables(spark, store)
    _load_orders(spark, sf_dir, targets, 1, orders.filter("o_orderstatus = 'F'"), "First ")
    _load_orders(spark, sf_dir, targets, 2, orders, "Second ")
    good = orders.join(X.products(spark, sf_dir).frame, F.col("o_orderkey") % 100 + 1 == F.col("prod_group_id"), "left_semi")
    corrected = good.filter("o_orderkey % 3 <> 0").orderBy(F.desc("o_orderkey"))
    _load_orders(spark, sf_dir, targets, 2, corrected, "Corrected ", replace=True)
    leads = _rows_of(spark, targets, "leads").select("LEAD_NUMBER", F.lit("lead").alias("kind"), F.col("LEAD_NAME").alias("note"), F.lit(None).cast("int").alias("BATCH_ID"))
    names = _rows_of(spark, targets, "leads").select("LEAD_ID", "LEAD_NUMBER")
    children = [
        _rows_of(spark, targets, table).join(names, "LEAD_ID", "left").select("LEAD_NUMBER", F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("note"), "BATCH_ID")
        for table, kind in (("members", "member"), ("items", "item"))
    ]
    staged = _rows_of(spark, targets, "staging").select(F.col(L.LEAD_NUMBER).alias("LEAD_NUMBER"), "BATCH_ID", "FILE_RECORD_NUM")
    errors = _rows_of(spark, targets, "errors").join(staged, ["BATCH_ID", "FILE_RECORD_NUM"]).select(
        "LEAD_NUMBER", F.lit("error").alias("kind"), F.col("ERROR_MESSAGE").alias("note"), "BATCH_ID"
    )
    return leads.unionByName(children[0]).unionByName(children[1]).unionByName(errors)


_REPLACED = _TWO + """
, corrected AS (SELECT * FROM judged WHERE product_ok AND o_orderkey % 3 <> 0),
taken AS (SELECT 1 AS batch, * FROM judged WHERE o_orderstatus = 'F' AND product_ok AND customer_ok
  UNION ALL SELECT 2, * FROM corrected WHERE customer_ok)
SELECT 'L' || o_orderkey AS LEAD_NUMBER, 'lead' AS kind,
  max(CASE WHEN batch = 2 THEN 'Corrected ' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'Second ' ELSE 'First ' END END || o_orderkey) FILTER (batch = last) AS note,
  CAST(NULL AS INTEGER) AS BATCH_ID
FROM (SELECT *, max(batch) OVER (PARTITION BY o_orderkey) AS last FROM taken) GROUP BY o_orderkey
UNION ALL SELECT 'L' || o_orderkey, unnest(['member', 'item']), NULL, batch FROM taken
UNION ALL SELECT 'L' || o_orderkey, 'error', CASE WHEN product_ok THEN 'Invalid Customer (CUSTOMER_ID)' ELSE 'Invalid Product (PROD_GROUP_ID)' END, 1
  FROM judged WHERE o_orderstatus = 'F' AND NOT (product_ok AND customer_ok)
UNION ALL SELECT 'L' || o_orderkey, 'error', 'Invalid Customer (CUSTOMER_ID)', 2 FROM corrected WHERE NOT customer_ok
"""


@query(_REPLACED)
def staged_replaced_batch(spark, sf_dir):
    return _replaced_batch(spark, sf_dir, store=False)


@query(_REPLACED)
def store_replaced_batch(spark, sf_dir):
    return _replaced_batch(spark, sf_dir, store=True)


@query(_TWO + """
, loaded AS (SELECT 1 AS batch, * FROM judged WHERE o_orderstatus = 'F' UNION ALL SELECT 2, * FROM judged)
SELECT batch AS BATCH_ID, CASE WHEN product_ok AND customer_ok THEN 'S' ELSE 'E' END AS IMPORT_STATUS_CODE,
  CASE WHEN batch = 2 AND o_orderstatus = 'F' AND product_ok AND customer_ok THEN 'U' END AS IMPORT_MODE,
  CASE WHEN NOT product_ok THEN 'Invalid Product (PROD_GROUP_ID)' WHEN NOT customer_ok THEN 'Invalid Customer (CUSTOMER_ID)' END AS ERROR_MESSAGE,
  count(*) AS n
FROM loaded GROUP BY ALL
""")
def staged_batches(spark, sf_dir):
    staging = spark.table(_two_batches(spark, sf_dir).staging)
    return staging.groupBy("BATCH_ID", "IMPORT_STATUS_CODE", "IMPORT_MODE", "ERROR_MESSAGE").agg(F.count(F.lit(1)).alias("n"))


@query(on_leads("""
SELECT CAST(CASE WHEN length(id) < 11 THEN lpad(id, 11, '0') ELSE id END AS VARCHAR) AS ERROR_ID, CAST(BATCH_ID AS VARCHAR) AS BATCH_ID,
  CAST(FILE_RECORD_NUM AS VARCHAR) AS FILE_RECORD_NUM, ERROR_MESSAGE
FROM (SELECT *, CAST(CASE ERROR_MESSAGE WHEN 'Invalid Product (PROD_GROUP_ID)' THEN 9000
    WHEN 'Invalid Customer (CUSTOMER_ID)' THEN 9100 ELSE 9200 END
  + row_number() OVER (PARTITION BY ERROR_MESSAGE ORDER BY FILE_RECORD_NUM) AS VARCHAR) AS id FROM status WHERE ERROR_MESSAGE IS NOT NULL)
"""))
def error_report(spark, sf_dir):
    path = scratch_path(spark, "error-report")
    create_csv(L.error_report(L.error_log(X.status(spark, sf_dir))), path)
    return read_delimited(spark, path)


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 10 = 0 THEN -1.0 ELSE o_totalprice END AS o_totalprice,
  o_orderstatus FROM orders
""")
def table_upsert_partitions(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    name = f"orders_{uuid.uuid4().hex[:12]}"
    orders.write.option("path", scratch_path(spark, name)).partitionBy("o_orderstatus").saveAsTable(name)
    changed = materialize(
        orders.filter("o_orderstatus = 'F' AND o_orderkey % 10 = 0").withColumn("o_totalprice", F.lit(-1.0)), "changed-orders"
    )
    part = touched(spark.table(name), changed, [("o_orderkey", "o_orderkey")], "o_orderstatus", "o_orderstatus")
    overwrite_partitions(upsert(part, changed, ["o_orderkey"], ["o_totalprice"]), name)
    return spark.table(name)


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS name FROM customer")
def table_append_publish(spark, sf_dir):
    customers = X.table(spark, sf_dir, "customer")
    name = f"customers_{uuid.uuid4().hex[:12]}"
    publish(customers.filter("c_custkey % 2 = 0").select("c_custkey", F.lit("first").alias("name")), name, bucket_by=["c_custkey"], buckets=4)
    publish(spark.table(name).withColumn("name", F.lit("even")), name)
    append(customers.filter("c_custkey % 2 <> 0").select(F.lit("odd").alias("name"), "c_custkey"), name)
    drop_old_versions(spark, name, keep=1)
    return spark.table(name)


@query(_TWO + """
SELECT 'lead' AS kind, 'L' || o_orderkey AS LEAD_NUMBER, NULL AS note FROM judged WHERE product_ok AND (customer_ok OR o_custkey % 7 = 0)
UNION ALL SELECT unnest(['member', 'item']), 'L' || o_orderkey, NULL FROM judged WHERE product_ok AND (customer_ok OR o_custkey % 7 = 0)
UNION ALL SELECT 'staged', 'L' || o_orderkey, CASE WHEN NOT product_ok THEN 'Invalid Product (PROD_GROUP_ID)'
  WHEN NOT customer_ok AND o_custkey % 7 <> 0 OR o_custkey % 7 = 1 THEN 'Invalid Customer (CUSTOMER_ID)' END FROM judged
UNION ALL SELECT 'error', 'L' || o_orderkey, CASE WHEN NOT product_ok THEN 'Invalid Product (PROD_GROUP_ID)' ELSE 'Invalid Customer (CUSTOMER_ID)' END FROM judged
  WHERE NOT product_ok OR NOT customer_ok AND o_custkey % 7 <> 0 OR o_custkey % 7 = 1
""")
def revalidated_batch(spark, sf_dir):
    # The list of parties gains some and loses others after the load.
    targets = _kept_tables(spark, store=True)
    _load_orders(spark, sf_dir, targets, 1, X.table(spark, sf_dir, "orders"), "First ")
    lists = X.parties(spark, sf_dir), X.products(spark, sf_dir)
    gained = X.table(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY' AND c_custkey % 7 = 0").select(F.col("c_custkey").alias("party_id"))
    parties = ReferenceList(lists[0].frame.filter("party_id % 7 <> 1").unionAll(gained), "party_id")
    jobs.revalidate_batches(spark, targets, lists, (parties, lists[1]))
    names = _rows_of(spark, targets, "leads").select("LEAD_ID", "LEAD_NUMBER")
    none = F.lit(None).cast("string").alias("note")
    staged = _rows_of(spark, targets, "staging").select("FILE_RECORD_NUM", F.col(L.LEAD_NUMBER).alias("LEAD_NUMBER"), "ERROR_MESSAGE")
    found = names.select(F.lit("lead").alias("kind"), "LEAD_NUMBER", none).unionAll(staged.select(F.lit("staged"), "LEAD_NUMBER", "ERROR_MESSAGE"))
    for table, kind in (("members", "member"), ("items", "item")):
        found = found.unionAll(_rows_of(spark, targets, table).join(names, "LEAD_ID", "left").select(F.lit(kind), "LEAD_NUMBER", none))
    errors = _rows_of(spark, targets, "errors").select("FILE_RECORD_NUM", F.col("ERROR_MESSAGE").alias("note"))
    return found.unionAll(errors.join(staged, "FILE_RECORD_NUM").select(F.lit("error"), "LEAD_NUMBER", "note"))


# --- tables of a store -----------------------------------------------------------------------


def _orders_store(spark, sf_dir, updates=None):
    """Orders in files by ranges of their key."""
    orders = X.table(spark, sf_dir, "orders")
    store = Store(spark, scratch_path(spark, "store"))
    load = store.begin()
    load.create("orders", orders.schema, ["o_orderkey"], updates)
    load.append("orders", _target(spark, sf_dir).repartitionByRange(16, "o_orderkey"))
    load.commit()
    return store


_UPSERTED = _TABLES + """
SELECT t.o_orderkey, t.o_custkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice, t.o_orderdate, t.o_orderpriority
FROM target t LEFT JOIN source s ON t.o_orderkey = s.o_orderkey
UNION ALL SELECT * FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = s.o_orderkey)
"""


@query(_UPSERTED)
def merge_by_files(spark, sf_dir):
    store, source = _orders_store(spark, sf_dir), _source(spark, sf_dir)
    load = store.begin()
    load.merge("orders", source, lambda part: upsert(part, source, ["o_orderkey"], ["o_orderstatus", "o_totalprice"]))
    load.commit()
    return store.read("orders")


def _logged_changes(spark, sf_dir):
    """A first round of changes that later ones take back in part."""
    store, source = _orders_store(spark, sf_dir, ["o_orderstatus", "o_totalprice"]), _source(spark, sf_dir)
    wrong = source.withColumns({"o_totalprice": F.lit(0.0), "o_orderstatus": F.lit("?")})
    for changes_of in (wrong.filter("o_orderkey % 2 = 0"), source):
        load = store.begin()
        load.log_changes("orders", changes_of)
        load.commit()
    return store


@query(_UPSERTED)
def merge_log_read(spark, sf_dir):
    return _logged_changes(spark, sf_dir).read("orders")


@query(_UPSERTED)
def merge_log_compacted(spark, sf_dir):
    store = _logged_changes(spark, sf_dir)
    load = store.begin()
    load.compact("orders")
    load.commit()
    return store.read("orders")


# --- whole job -------------------------------------------------------------------------------


_LABELLED = """
, parsed AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
    l_extendedprice) AS n FROM lines),
labelled AS (SELECT p.*, CASE WHEN bad THEN 'malformed'
    WHEN "leadNumber" IS NULL OR "primaryContactId" IS NULL OR "PartyUsageCode" IS NULL THEN 'missing_required'
    WHEN "productGroupId" IS NULL THEN 'missing_product_group'
    WHEN "customerId" NOT IN (SELECT party_id FROM parties) THEN 'unknown_customer'
    WHEN "primaryContactId" NOT IN (SELECT party_id FROM parties) THEN 'unknown_contact'
    WHEN "productGroupId" NOT IN (SELECT prod_group_id FROM products) THEN 'unknown_product'
    WHEN "leadNumber" IN (SELECT lead_number FROM existing) THEN 'update' ELSE 'insert' END AS outcome FROM parsed p)
"""


@query(on_leads(_LABELLED + """
SELECT n AS "FILE_RECORD_NUM", "leadNumber", "customerId",
  CASE WHEN outcome = 'insert' AND row_number() OVER (PARTITION BY "leadNumber", outcome ORDER BY n) > 1
    THEN 'duplicate' ELSE outcome END AS outcome
FROM labelled
"""))
def intake_end_to_end(spark, sf_dir):
    result = jobs.validated_intake(
        spark, X.lead_file(spark, sf_dir), scratch_path(spark, "intake"), X.parties(spark, sf_dir),
        X.products(spark, sf_dir), X.existing_leads(spark, sf_dir), at=X.STAMP, by="GS1",
    )
    columns = ["FILE_RECORD_NUM", "leadNumber", "customerId"]
    others = result.frames["outcomes"].filter("outcome <> 'insert'").select(*columns, "outcome")
    repeats = result.frames["duplicates"].select(*columns, F.lit("duplicate").alias("outcome"))
    new = result.frames["leads"].select(
        F.col("LEAD_ID").alias("FILE_RECORD_NUM"), F.col("LEAD_NUMBER").alias("leadNumber"),
        F.col("CUSTOMER_ID").alias("customerId"), F.lit("insert").alias("outcome"),
    )
    return others.unionByName(repeats).unionByName(new)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS o_totalprice,
  CASE WHEN o_orderkey % 11 = 0 THEN TIMESTAMP '1999-06-01 00:00:00' ELSE o_orderdate END AS o_orderdate
FROM orders WHERE CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey % 2 = 1
  ELSE o_orderdate > TIMESTAMP '1999-07-01 00:00:00' - INTERVAL 1000 DAY AND o_orderdate <= TIMESTAMP '1999-07-01 00:00:00' AND o_custkey % 2 = 1 END
""")
def extract_refresh(spark, sf_dir):
    # A year after the first extract every eleventh order has changed, and half of these no longer qualify.
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    moved = F.col("o_orderkey") % 11 == 0
    later = orders.withColumns({
        "o_totalprice": F.when(moved, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_orderdate": F.when(moved, F.lit("1999-06-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("o_orderdate")),
        "wanted": F.when(moved, F.col("o_orderkey") % 2 == 1).otherwise(F.col("o_custkey") % 2 == 1),
    })
    first = orders.withColumn("wanted", F.col("o_custkey") % 2 == 1)
    store = Store(spark, scratch_path(spark, "store"))
    for rows, as_of in ((first, datetime(1998, 7, 1)), (later, datetime(1999, 7, 1))):
        found = refresh_extract(store, "orders", rows, "o_orderkey", "o_orderdate", days=1000, as_of=as_of, keep=F.col("wanted"))
    return found.drop("wanted")


_FIRST = _LABELLED + """
, first AS (SELECT *, row_number() OVER (PARTITION BY "leadNumber" ORDER BY n) AS place FROM labelled WHERE outcome = 'insert')
"""


@query(on_leads(_FIRST + """
SELECT n AS LEAD_ID, "leadNumber" AS LEAD_NUMBER, "customerId" AS CUSTOMER_ID, "leadName" AS LEAD_NAME,
  "PartyRole" AS PARTY_ROLE, "productGroupId" AS PRODUCT_GROUP_ID, 'GS1' AS CREATED_BY
FROM first WHERE place = 1
"""))
def intake_tables(spark, sf_dir):
    tag = uuid.uuid4().hex[:12]
    store = Store(spark, scratch_path(spark, "store"))
    targets = jobs.LeadTables(f"leads_{tag}", f"members_{tag}", f"items_{tag}", store=store)
    jobs.validated_intake(
        spark, X.lead_file(spark, sf_dir), scratch_path(spark, "intake"), X.parties(spark, sf_dir), X.products(spark, sf_dir),
        X.existing_leads(spark, sf_dir), targets=targets, at=X.STAMP, by="GS1",
    )
    found = store.read(targets.leads).join(store.read(targets.members).select("LEAD_ID", "PARTY_ROLE"), "LEAD_ID", "full")
    found = found.join(store.read(targets.items).select("LEAD_ID", "PRODUCT_GROUP_ID"), "LEAD_ID", "full")
    return found.select("LEAD_ID", "LEAD_NUMBER", "CUSTOMER_ID", "LEAD_NAME", "PARTY_ROLE", "PRODUCT_GROUP_ID", "CREATED_BY")


@query(on_leads(_FIRST + """
SELECT 'format_errors' AS file, CAST(n AS VARCHAR) AS id, line AS content FROM labelled WHERE outcome = 'malformed'
UNION ALL SELECT outcome, CAST(n AS VARCHAR), "leadName" FROM labelled WHERE outcome NOT IN ('malformed', 'update', 'insert')
UNION ALL SELECT unnest(['leads', 'members', 'items']), CAST(n AS VARCHAR), unnest(["leadNumber", "PartyRole", CAST("productGroupId" AS VARCHAR)]) FROM first WHERE place = 1
"""))
def intake_files(spark, sf_dir):
    out = scratch_path(spark, "intake")
    jobs.validated_intake(
        spark, X.lead_file(spark, sf_dir), out, X.parties(spark, sf_dir), X.products(spark, sf_dir), X.existing_leads(spark, sf_dir), at=X.STAMP, by="GS1",
    )
    part = lambda path, kind, key, content: read_delimited(spark, f"{out}/{path}").select(
        (F.lit(kind) if kind else F.col("reject_reason")).alias("file"), F.col(key).alias("id"), F.col(content).alias("content")
    )
    found = part("format_errors", "format_errors", "FILE_RECORD_NUM", "malformed_line").unionAll(part("rejects", None, "FILE_RECORD_NUM", "leadName"))
    for name, content in (("leads", "LEAD_NUMBER"), ("members", "PARTY_ROLE"), ("items", "PRODUCT_GROUP_ID")):
        found = found.unionAll(part(f"success/{name}", name, "LEAD_ID", content))
    return found


@query(on_leads(_FIRST + """
SELECT CAST(n AS VARCHAR) AS LEAD_ID, "leadNumber" AS LEAD_NUMBER, "leadName" AS LEAD_NAME FROM first WHERE place = 1
"""))
def intake_committed_files(spark, sf_dir):
    # A first load against a list of leads that knows none; the files of the second take the place of its files.
    out, path = scratch_path(spark, "intake"), X.lead_file(spark, sf_dir)
    none = ReferenceList(spark.createDataFrame([], "lead_number string"), "lead_number")
    for existing in (none, X.existing_leads(spark, sf_dir)):
        jobs.validated_intake(spark, path, out, X.parties(spark, sf_dir), X.products(spark, sf_dir), existing, at=X.STAMP, by="GS1", runs=True)
    return read_delimited(spark, f"{committed_run(spark, out)}/success/leads").select("LEAD_ID", "LEAD_NUMBER", "LEAD_NAME")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'again ' ELSE '' END || c_name AS c_name,
  CASE WHEN c_custkey % 5 = 0 AND c_custkey % 3 <> 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer
""")
def direct_upsert_table(spark, sf_dir):
    customers = X.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment")
    store, paths = Store(spark, scratch_path(spark, "store")), [scratch_path(spark, "customer-file") for _ in "12"]
    empty = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("c_mktsegment")
    write_csv(customers.select("c_custkey", "c_name", empty), paths[0])
    write_csv(customers.filter("c_custkey % 3 = 0").select("c_custkey", F.concat(F.lit("again "), "c_name").alias("c_name"), "c_mktsegment"), paths[1])
    for path in paths:
        found = jobs.direct_upsert(spark, path, "customers", customers.schema, ["c_custkey"], ["c_name", "c_mktsegment"], store=store)
    return found


@query(f"""SELECT CAST(p_partkey AS VARCHAR) AS PROD_GROUP_ID, p_name AS PROD_GROUP_NAME, {_STAMPED} FROM part, range(2)""")
def reference_upload_table(spark, sf_dir):
    store, path = Store(spark, scratch_path(spark, "store")), scratch_path(spark, "part-file")
    write_csv(X.table(spark, sf_dir, "part").select("p_partkey", "p_name"), path)
    for _ in range(2):
        found = jobs.reference_upload(spark, path, "groups", {"p_partkey": "PROD_GROUP_ID", "p_name": "PROD_GROUP_NAME"}, store=store, at=X.STAMP, by="GS1")
    return found


@query(_TWO + """
SELECT 'staging' AS name, 2 AS BATCH_ID, count(*) AS n FROM judged
UNION ALL SELECT 'errors', 2, count(*) FILTER (NOT (product_ok AND customer_ok)) FROM judged
UNION ALL SELECT 'members', batch, count(*) FROM (SELECT 1 AS batch, * FROM judged WHERE o_orderstatus = 'F' UNION ALL SELECT 2, * FROM judged)
  WHERE product_ok AND customer_ok GROUP BY batch
""")
def retired_batches(spark, sf_dir):
    targets = _two_batches(spark, sf_dir)
    jobs.retire_batches(spark, targets, [1])
    counted = [_rows_of(spark, targets, n).groupBy("BATCH_ID").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "BATCH_ID", "n") for n in ("staging", "errors", "members")]
    return counted[0].unionAll(counted[1]).unionAll(counted[2])


@query(_TWO + "SELECT 'lead' AS kind, 'L' || o_orderkey AS LEAD_NUMBER FROM judged WHERE product_ok AND customer_ok AND o_orderkey % 4 = 0")
def cleaned_lead_tables(spark, sf_dir):
    targets = _kept_tables(spark, store=True)
    _load_orders(spark, sf_dir, targets, 1, X.table(spark, sf_dir, "orders"), "First ")
    jobs.clean_lead_tables(spark, targets)
    left = [_rows_of(spark, targets, n).select(F.lit(k).alias("kind"), F.col(c).alias("LEAD_NUMBER")) for n, k, c in (("leads", "lead", "LEAD_NUMBER"), ("members", "member", "PARTY_ROLE"), ("items", "item", "CONV_CURR_CODE"))]
    return left[0].unionAll(left[1]).unionAll(left[2])


@query("""
SELECT CAST(o_orderkey AS INTEGER) AS k, CAST(o_orderkey AS BIGINT) * 10000000000 AS big, o_totalprice AS price, o_orderkey % 2 = 0 AS even,
  o_orderdate AS at, CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'last' ELSE CAST(o_orderkey AS VARCHAR) END AS changing,
  NULL::VARCHAR AS nothing
FROM orders
""")
def csv_inferred_types(spark, sf_dir):
    path, orders = scratch_path(spark, "typed-file"), X.table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    write_csv(
        orders.orderBy("o_orderkey").select(
            F.col("o_orderkey").alias("k"), (F.col("o_orderkey").cast("bigint") * 10_000_000_000).alias("big"), F.col("o_totalprice").alias("price"),
            (F.col("o_orderkey") % 2 == 0).alias("even"), F.col("o_orderdate").cast("string").alias("at"),
            F.when(F.col("o_orderkey") == last, "last").otherwise(F.col("o_orderkey").cast("string")).alias("changing"), F.lit(None).cast("string").alias("nothing"),
        ),
        path,
    )
    return read_delimited(spark, path, infer=True)
