"""Layouts of the input files and the renames from input field to target column."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(fields: str) -> T.StructType:
    pairs = (field.split() for field in fields.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Field names, order and types of the three lead file layouts.
LEAD_FILE = _struct(
    "leadNumber string, customerId long, primaryContactId long, leadName string, dealSize int, "
    "city string, state string, Country string, PartyUsageCode string, PartyRole string, "
    "productGroupId long, currCode string, BudgetAmount int, _corrupt_record string"
)
LEAD_FILE_WIDE = _struct(
    "LeadNumber string, CustomerId long, PrimaryContactId long, LeadName string, DealSize int, "
    "City string, State string, Country string, BudgetAmount int, PartyUsageCode string, "
    "PartyRole string, productGroupId long, currCode string, _corrupt_record string"
)
LEAD_FILE_NARROW = _struct(
    "LeadNumber string, CustomerId long, PrimaryContactId long, LeadName string, DealSize int, "
    "City string, State string, Country string, BudgetAmount int, _corrupt_record string"
)

# Target table columns.
SCHOOL = _struct(
    "schoolID string, schoolName string, schoolCity string, schoolState string, schoolNickName string"
)
_AUDIT = (
    "CREATION_DATE timestamp_ntz, LAST_UPDATE_DATE timestamp_ntz, CREATED_BY string, LAST_UPDATED_BY string"
)
LEADS = _struct(
    "LEAD_ID long, LEAD_NUMBER string, CUSTOMER_ID long, PRIMARY_CONTACT_ID long, LEAD_NAME string, "
    "DEAL_SIZE int, CITY string, STATE string, COUNTRY string, BUDGET_AMOUNT int, " + _AUDIT
)
LEAD_MEMBERS = _struct(
    "MKL_LEAD_TC_MEMBER_ID string, LEAD_ID long, PARTY_USAGE_CODE string, PARTY_ID long, "
    "PARTY_ROLE string, " + _AUDIT
)
LEAD_ITEMS = _struct(
    "PROD_ASSOC_ID string, LEAD_ID long, PRODUCT_GROUP_ID long, CONV_CURR_CODE string, " + _AUDIT
)
IMPORT_ERRORS = _struct("ERROR_ID string, BATCH_ID int, FILE_RECORD_NUM long, ERROR_MESSAGE string")
PARTIES = _struct(
    "PARTY_ID long, PARTY_NUMBER string, SOURCE_SYSTEM string, SOURCE_SYSTEM_REFERENCE string, "
    "PREF_FUNCTIONAL_CURRENCY string, ORGANIZATION_NAME string, SALES_PROFILE_TYPE string, "
    "OWNER_PARTY_NUMBER string, OWNER_PARTY_ID string, ORGANIZATION_TYPE string, NAMED_FLAG string, "
    "ADDRESS_LINE string, COUNTRY string, STATE string, COUNTY string, CITY string, "
    "POSTAL_CODE string, GEOGRAPHY_ID string, INDUSTRY_CODE string, ORG_TYPE_CATEGORY string, "
    "ORG_TYPE string, " + _AUDIT
)
PRODUCT_GROUPS = _struct(
    "PROD_GROUP_ID string, LANGUAGE string, SOURCE_LANG string, PROD_GROUP_NAME string, "
    "ADMIN_PROD_GRP_NAME string, " + _AUDIT
)

# Input field -> target column.
LEAD_RENAMES = {
    "LEAD_ID": "LEAD_ID",
    "leadNumber": "LEAD_NUMBER",
    "customerId": "CUSTOMER_ID",
    "primaryContactId": "PRIMARY_CONTACT_ID",
    "leadName": "LEAD_NAME",
    "dealSize": "DEAL_SIZE",
    "city": "CITY",
    "state": "STATE",
    "BudgetAmount": "BUDGET_AMOUNT",
}
MEMBER_RENAMES = {
    "LEAD_ID": "LEAD_ID",
    "PartyUsageCode": "PARTY_USAGE_CODE",
    "primaryContactId": "PARTY_ID",
    "PartyRole": "PARTY_ROLE",
}
ITEM_RENAMES = {
    "LEAD_ID": "LEAD_ID",
    "productGroupId": "PRODUCT_GROUP_ID",
    "currCode": "CONV_CURR_CODE",
}
PARTY_RENAMES = {
    name: name
    for name in PARTIES.fieldNames()
    if name not in ("PARTY_ID", "CREATION_DATE", "LAST_UPDATE_DATE", "CREATED_BY", "LAST_UPDATED_BY")
}
PRODUCT_RENAMES = {
    "ProdGroupId": "PROD_GROUP_ID",
    "Language": "LANGUAGE",
    "SourceLang": "SOURCE_LANG",
    "ProdGroupName": "PROD_GROUP_NAME",
    "AdminProdGroupName": "ADMIN_PROD_GRP_NAME",
}


def staging_renames(layout: T.StructType) -> dict[str, str]:
    """Input field -> generic staging attribute; the attributes are numbered from 002 in file order."""
    fields = [name for name in layout.fieldNames() if name != CORRUPT]
    return {name: f"ATTRIBUTE_SMALL_CHAR{i:03d}" for i, name in enumerate(fields, start=2)}


# Columns that an update sets, per target.
SCHOOL_UPDATES = ["schoolName", "schoolCity", "schoolState", "schoolNickName"]
LEAD_UPDATES = [
    "CUSTOMER_ID", "PRIMARY_CONTACT_ID", "LEAD_NAME", "CITY", "STATE", "BUDGET_AMOUNT",
    "LAST_UPDATE_DATE", "LAST_UPDATED_BY",
]
LEAD_INSERTS = [
    "LEAD_ID", "LEAD_NUMBER", "CUSTOMER_ID", "PRIMARY_CONTACT_ID", "LEAD_NAME", "CITY", "STATE",
    "BUDGET_AMOUNT", "CREATION_DATE", "LAST_UPDATE_DATE", "LAST_UPDATED_BY", "CREATED_BY",
]
MEMBER_UPDATES = ["LEAD_ID", "PARTY_USAGE_CODE", "PARTY_ID", "PARTY_ROLE", "LAST_UPDATE_DATE", "LAST_UPDATED_BY"]
ITEM_UPDATES = ["LEAD_ID", "PRODUCT_GROUP_ID", "CONV_CURR_CODE", "LAST_UPDATE_DATE", "LAST_UPDATED_BY"]

# Status report and error report columns.
STATUS_REPORT = [
    "INTERFACE_ROW_ID", "BATCH_ID", "FILE_RECORD_NUM", "PK1", "ATTRIBUTE_SMALL_CHAR002",
    "IMPORT_STATUS_CODE", "IMPORT_MODE",
]
ERROR_REPORT = ["ERROR_ID", "BATCH_ID", "FILE_RECORD_NUM", "ERROR_MESSAGE"]
