"""Delimited text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluice.operators.numbering import number_records, with_place
from sluice.schemas import CORRUPT
from sluice.scratch import materialize


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    *,
    infer: bool = False,
    header: bool = True,
) -> DataFrame:
    """CSV as all strings, with inferred types, or with ``schema``.

    A schema with a corrupt-record column keeps malformed lines there. ``infer`` is ``store_inferred``.
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        return (
            reader.schema(schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path)
        )
    rows = reader.csv(path)
    return store_inferred(rows) if infer else rows


_DIGITS = r"^[+-]?[0-9]+$"
_DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^(NaN|[+-]?Inf(inity)?)$"
#: From narrow to wide; a column gets the first type that holds all its values.
_TYPES = {
    "boolean": lambda c: F.lower(c).isin("true", "false"),
    "int": lambda c: c.rlike(_DIGITS) & c.try_cast("int").isNotNull(),
    "bigint": lambda c: c.rlike(_DIGITS) & c.try_cast("bigint").isNotNull(),
    "double": lambda c: c.rlike(_DECIMAL) & c.try_cast("double").isNotNull(),
    "timestamp_ntz": lambda c: c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}") & c.try_cast("timestamp_ntz").isNotNull(),
}


def narrowest_types(rows: DataFrame) -> dict[str, str]:
    """The narrowest type that holds all values of each text column, in one aggregate.

    Every task says of each column which types hold what it has seen, and that is merged by 'and', so the order
    of the rows and a last row of another type make no difference. A column without values stays text.
    """
    held = [F.every(F.col(f"`{c}`").isNull() | fits(F.col(f"`{c}`"))).alias(f"{n} {t}") for n, c in enumerate(rows.columns) for t, fits in _TYPES.items()]
    some = [F.count(F.col(f"`{c}`")).alias(f"{n} values") for n, c in enumerate(rows.columns)]
    facts = rows.agg(*held, *some).first().asDict()
    return {
        c: next((t for t in _TYPES if facts[f"{n} values"] and facts[f"{n} {t}"]), "string") for n, c in enumerate(rows.columns)
    }


def store_inferred(rows: DataFrame) -> DataFrame:
    """Text columns in the types that their values have; the file behind ``rows`` is read once and stored as text."""
    stored = materialize(rows, "text-columns")
    return stored.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in narrowest_types(stored).items()])


def scan_delimited(
    spark: SparkSession, path: str | list[str], schema: T.StructType, *, header: bool = True
) -> DataFrame:
    """Parsed rows with the place of each in the file, for ``number_records`` once they are stored.

    All columns must be parsed: a pruned CSV scan would judge lines by the columns in use.
    """
    return with_place(read_delimited(spark, path, schema, header=header))


def store_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    number: str = "FILE_RECORD_NUM",
    *,
    header: bool = True,
) -> DataFrame:
    """Parse once and store as Parquet, with the dense record number in file order."""
    scanned = scan_delimited(spark, path, schema, header=header)
    return number_records(materialize(scanned, "scanned"), number)


def malformed(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNotNull())


def well_formed(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def physical_lines(spark: SparkSession, path: str | list[str]) -> int:
    """Lines of text, headers and the inner lines of quoted fields included."""
    return spark.read.text(path).count()
