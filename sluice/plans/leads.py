"""Lead intake: target rows, staging rows, import status, errors, children, reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from sluice import schemas
from sluice.functions.stamp import as_text, audit, batch, padded, rename
from sluice.operators.lookups import ReferenceList, flag_known
from sluice.operators.numbering import renumber
from sluice.operators.rules import Required, Rule, Unknown, classify
from sluice.operators.upsert import merge_rows

# Required fields of the two kinds of job.
REQUIRED = ["leadNumber", "customerId", "primaryContactId", "leadName", "PartyUsageCode"]
REQUIRED_NARROW = ["leadNumber", "customerId", "primaryContactId", "leadName"]

# Error messages and the bases of their error ids.
INVALID_PRODUCT = "Invalid Product (PROD_GROUP_ID)"
INVALID_CUSTOMER = "Invalid Customer (CUSTOMER_ID)"
INVALID_CONTACT = "Invalid Contact (PRIMARY_CONTACT_ID)"
ERROR_BASES = {INVALID_PRODUCT: 9000, INVALID_CUSTOMER: 9100, INVALID_CONTACT: 9200}
CHILD_BASE = 1000

# Staging attributes of the lead fields.
LEAD_NUMBER, CUSTOMER, CONTACT, LEAD_NAME = (f"ATTRIBUTE_SMALL_CHAR00{i}" for i in (2, 3, 4, 5))
DEAL_SIZE, CITY, STATE, COUNTRY = (f"ATTRIBUTE_SMALL_CHAR00{i}" for i in (6, 7, 8, 9))
BUDGET, PARTY_USAGE, PARTY_ROLE, PRODUCT, CURRENCY = (
    f"ATTRIBUTE_SMALL_CHAR0{i}" for i in (10, 11, 12, 13, 14)
)
STAGED_LEAD_UPDATES = {
    "CUSTOMER_ID": CUSTOMER,
    "PRIMARY_CONTACT_ID": CONTACT,
    "LEAD_NAME": LEAD_NAME,
    "DEAL_SIZE": DEAL_SIZE,
    "CITY": CITY,
    "STATE": STATE,
    "COUNTRY": COUNTRY,
    "BUDGET_AMOUNT": BUDGET,
    "LAST_UPDATE_DATE": "LAST_UPDATE_DATE",
    "LAST_UPDATED_BY": "LAST_UPDATED_BY",
}
STAGED_LEAD_INSERTS = {
    "LEAD_ID": "PK1",
    "LEAD_NUMBER": LEAD_NUMBER,
    **STAGED_LEAD_UPDATES,
    "CREATION_DATE": "CREATION_DATE",
    "CREATED_BY": "CREATED_BY",
}


def intake_rules(parties: ReferenceList, products: ReferenceList) -> list[Rule]:
    """Order of the validated intake: fields, then customer, contact, product."""
    return [
        Required(REQUIRED, "missing_required"),
        Required(["productGroupId"], "missing_product_group"),
        Unknown("customerId", parties, "unknown_customer"),
        Unknown("primaryContactId", parties, "unknown_contact"),
        Unknown("productGroupId", products, "unknown_product"),
    ]


def staged_rules(parties: ReferenceList, products: ReferenceList | None) -> list[Rule]:
    """Order of the staged intake: product (where the layout has one), customer, contact."""
    rules: list[Rule] = []
    if products is not None:
        rules.append(Unknown(PRODUCT, products, INVALID_PRODUCT, sql_not_in=True))
    rules.append(Unknown(CUSTOMER, parties, INVALID_CUSTOMER, sql_not_in=True))
    rules.append(Unknown(CONTACT, parties, INVALID_CONTACT, sql_not_in=True))
    return rules


def standardise_leads(df: DataFrame, at: datetime | str, by: str) -> DataFrame:
    return audit(rename(df, schemas.LEAD_RENAMES), at, by)


def standardise_members(df: DataFrame, at: datetime | str, by: str) -> DataFrame:
    """One member row per lead; a lead has one, so its id serves as the member id too."""
    members = rename(df, schemas.MEMBER_RENAMES)
    return audit(members.withColumn("MKL_LEAD_TC_MEMBER_ID", F.col("LEAD_ID").cast("string")), at, by)


def standardise_items(df: DataFrame, at: datetime | str, by: str) -> DataFrame:
    items = rename(df, schemas.ITEM_RENAMES)
    return audit(items.withColumn("PROD_ASSOC_ID", F.col("LEAD_ID").cast("string")), at, by)


def stage_rows(
    df: DataFrame,
    layout: T.StructType,
    batch_id: int,
    at: datetime | str,
    by: str,
    record_number: str = "FILE_RECORD_NUM",
    key: str | None = None,
) -> DataFrame:
    """Staging rows: lead fields as text attributes, record number, row id and key, stamps.

    ``key`` names the column with the lead id; by default it is the record number.
    """
    names = schemas.staging_renames(layout)
    text = as_text(df, list(names))
    staged = text.select(
        *[F.col(old).alias(new) for old, new in names.items()],
        F.col(record_number).alias("FILE_RECORD_NUM"),
        F.col(record_number).alias("INTERFACE_ROW_ID"),
        F.col(key or record_number).alias("PK1"),
    )
    return batch(audit(staged, at, by), batch_id)


def import_status(
    staged: DataFrame,
    batch_id: int,
    rules: Sequence[Rule],
    lead_ids: ReferenceList,
) -> DataFrame:
    """Rows of the batch with ERROR_MESSAGE, IMPORT_STATUS_CODE ('I' or 'E') and IMPORT_MODE.

    The status a row ends up with follows from the first rule it breaks, so the chain of updates
    becomes one projection. IMPORT_MODE is 'U' for known lead ids.
    """
    rows = staged.filter(F.col("BATCH_ID") == batch_id)
    judged = classify(rows, rules, "ERROR_MESSAGE")
    marked = flag_known(judged, "PK1", lead_ids, "__known", null_safe=False, stored=rows, bits_first=True)
    return marked.withColumns(
        {
            "IMPORT_STATUS_CODE": F.when(F.col("ERROR_MESSAGE").isNull(), "I").otherwise("E"),
            "IMPORT_MODE": F.when(F.col("__known"), "U"),
        }
    ).drop("__known")


def error_log(status: DataFrame, bases: Mapping[str, int] = ERROR_BASES) -> DataFrame:
    """One row per failed row, with a padded id counted per message in record order.

    BATCH_ID, ERROR_MESSAGE and ERROR_ID together are unique. The usual ``bases`` leave room for 100
    errors per message; with bases farther apart ERROR_ID alone is unique in a batch.
    """
    failed = status.filter(F.col("IMPORT_STATUS_CODE") == "E").select(
        "BATCH_ID", "FILE_RECORD_NUM", "ERROR_MESSAGE"
    )
    numbered = renumber(failed, "FILE_RECORD_NUM", "__number", within=["ERROR_MESSAGE"])
    base = F.coalesce(*[F.when(F.col("ERROR_MESSAGE") == m, b) for m, b in bases.items()])
    return numbered.select(
        padded(base + F.col("__number")).alias("ERROR_ID"), "BATCH_ID", "FILE_RECORD_NUM", "ERROR_MESSAGE"
    )


def accepted_rows(status: DataFrame) -> DataFrame:
    """Rows in state 'I', updates included, numbered in record order for their children."""
    taken = status.filter(F.col("IMPORT_STATUS_CODE") == "I")
    return renumber(taken, "FILE_RECORD_NUM", "CHILD_NUMBER")


_STAMPS = ["CREATION_DATE", "LAST_UPDATE_DATE", "LAST_UPDATED_BY", "CREATED_BY"]


def member_rows(taken: DataFrame, base: int = CHILD_BASE) -> DataFrame:
    """Member rows of accepted rows, with ids above ``base``."""
    return taken.select(
        padded(F.col("CHILD_NUMBER") + base).alias("MKL_LEAD_TC_MEMBER_ID"),
        F.col("PK1").alias("LEAD_ID"),
        F.col(PARTY_USAGE).alias("PARTY_USAGE_CODE"),
        F.col(CONTACT).cast("long").alias("PARTY_ID"),
        F.col(PARTY_ROLE).alias("PARTY_ROLE"),
        *_STAMPS,
    )


def item_rows(taken: DataFrame, base: int = CHILD_BASE) -> DataFrame:
    """Item rows of accepted rows, with ids above ``base``."""
    return taken.select(
        padded(F.col("CHILD_NUMBER") + base).alias("PROD_ASSOC_ID"),
        F.col("PK1").alias("LEAD_ID"),
        F.col(PRODUCT).cast("long").alias("PRODUCT_GROUP_ID"),
        F.col(CURRENCY).alias("CONV_CURR_CODE"),
        *_STAMPS,
    )


def merge_leads(leads: DataFrame, status: DataFrame) -> DataFrame:
    """Lead table after the merge of the rows in state 'I': update in mode 'U', else insert.

    ``status`` should be a stored table.
    """
    taken = F.col("IMPORT_STATUS_CODE") == "I"
    return merge_rows(
        leads,
        status,
        [("LEAD_ID", "PK1")],
        STAGED_LEAD_UPDATES,
        STAGED_LEAD_INSERTS,
        matched_when=taken & (F.col("IMPORT_MODE") == "U"),
        insert_when=taken,
    )


def inserted_leads(status: DataFrame, schema: T.StructType) -> DataFrame:
    """The new leads alone, for an append; only where no row is in mode 'U'."""
    taken = status.filter(F.col("IMPORT_STATUS_CODE") == "I")
    return taken.select(
        *[(F.col(STAGED_LEAD_INSERTS[f.name]) if f.name in STAGED_LEAD_INSERTS else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def finished(status: DataFrame) -> DataFrame:
    """Status after the load: 'I' becomes 'S'."""
    code = F.col("IMPORT_STATUS_CODE")
    return status.withColumn("IMPORT_STATUS_CODE", F.when(code == "I", "S").otherwise(code))


def status_report(done: DataFrame) -> DataFrame:
    report = done.select(*schemas.STATUS_REPORT).orderBy("FILE_RECORD_NUM")
    return as_text(report)


def error_report(errors: DataFrame) -> DataFrame:
    return as_text(errors.select(*schemas.ERROR_REPORT).orderBy("FILE_RECORD_NUM"))
