"""Joins to a side with unique keys: size-checked broadcast, else a shuffle that splits hot keys."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.scratch import materialize

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 100_000
# A key with more than 1/1000 of the rows is hot, so there are at most 1000 hot keys.
HOT_SHARE = 1000
#: Whole-number keys that share a row of bits: four longs.
WORD_KEYS, _PARTS = 256, 4
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _setting(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(f"sluice.{name}", str(default)))


def measured_bytes(df: DataFrame) -> int | None:
    """Bytes that the rows of ``df`` hold, summed over the data; None for nested columns."""
    row = F.lit(48)
    widths = [row]
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return None
        else:
            widths.append(F.lit(16))
    return df.agg(F.sum(reduce(add, widths).cast("long"))).first()[0] or 0


def fits_broadcast(df: DataFrame) -> bool:
    size = measured_bytes(df)
    return size is not None and size <= _setting(df, "broadcastBytes", BROADCAST_BYTES)


def hot_keys(df: DataFrame, key_hash: Column) -> dict[int, list[int]]:
    """Hashes of the keys that hold more than one thousandth of the rows, by the tasks they need.

    One pass with a bounded sketch per task; it only steers where rows go, never which rows are
    kept, so an estimate is enough. A key gets as many tasks as its share of all shuffle
    partitions, rounded up to a power of two: together not many more than there are partitions.
    """
    hot_rows = _setting(df, "hotRows", HOT_ROWS)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        df.select(key_hash.alias("h"))
        .agg(F.count(F.lit(1)).alias("n"), F.expr("approx_top_k(h, 1000, 10000)").alias("top"))
        .first()
    )
    hot: dict[int, list[int]] = {}
    for key in (found["top"] or []) if found["n"] else []:
        if key["count"] > max(found["n"] / HOT_SHARE, hot_rows):
            tasks = max(2, math.ceil(partitions * key["count"] / found["n"]))
            hot.setdefault(1 << (tasks - 1).bit_length(), []).append(key["item"])
    return hot


def _salts(key_hash: Column, hot: dict[int, list[int]]) -> Column:
    return F.coalesce(*[F.when(key_hash.isin(hashes), n) for n, hashes in hot.items()], F.lit(1))


def left_join_unique(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    *,
    null_safe: bool = False,
    small: bool | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Left join to ``right``, whose rows have unique ``on`` keys; its keys are dropped.

    ``right`` is broadcast when its measured size allows (``small``, if the caller has measured
    it). Otherwise both sides are shuffled, and
    rows of hot keys are spread: each input task of ``left`` sends them to its own salt, and the
    one matching row of ``right`` is repeated per salt. The salt comes from the partition number,
    so that a task run again sends its rows to the same place. Hot keys are sought in ``stored``,
    by default ``left``; give the table that ``left`` was derived from to save the work between.
    """
    names = [f"__right_{i}" for i in range(len(on))]
    keys = [F.col(r).cast(left.schema[l].dataType).alias(n) for (l, r), n in zip(on, names)]
    right_keys = {r for _, r in on}
    right = right.select(*keys, *[c for c in right.columns if c not in right_keys])
    if fits_broadcast(right) if small is None else small:
        joined = left.join(F.broadcast(right), _match(on, names, null_safe), "left")
        return joined.drop(*names)
    left_hash = F.xxhash64(*[F.col(l) for l, _ in on])
    hot = hot_keys(left if stored is None else stored, left_hash)
    if not hot:
        return left.join(right, _match(on, names, null_safe), "left").drop(*names)
    left = left.withColumn("__salt", F.pmod(F.spark_partition_id(), _salts(left_hash, hot)))
    right = right.withColumn(
        "__right_salt", F.explode(F.sequence(F.lit(0), _salts(F.xxhash64(*names), hot) - 1))
    )
    match = _match(on, names, null_safe) & (F.col("__salt") == F.col("__right_salt"))
    return left.join(right, match, "left").drop(*names, "__salt", "__right_salt")


def _match(on: list[tuple[str, str]], names: list[str], null_safe: bool) -> Column:
    pairs = [(F.col(l), F.col(n)) for (l, _), n in zip(on, names)]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


class ReferenceList:
    """A list of allowed keys. Duplicates in it never change the number of checked rows."""

    def __init__(self, frame: DataFrame, key: str):
        self.frame = frame
        self.key = key
        self._keys: dict[str, tuple[DataFrame, bool]] = {}
        self._fits: dict[str, bool] = {}
        self._facts: dict[str, bool] = {}
        self._bits: list[DataFrame | None] = []

    def keys(self, data_type: T.DataType) -> DataFrame:
        """Distinct keys as column ``__ref``, in the type of the checked column."""
        return self._sized(data_type)[0]

    def is_small(self, data_type: T.DataType) -> bool:
        return self._sized(data_type)[1]

    def _sized(self, data_type: T.DataType) -> tuple[DataFrame, bool]:
        name = data_type.simpleString()
        if name not in self._keys:
            source = F.col(self.key)
            typed = source.try_cast(data_type)
            # An entry that is no value of the column's type can match no row.
            keys = (
                self.frame.filter(typed.isNotNull() | source.isNull())
                .select(typed.alias("__ref"))
                .distinct()
            )
            # The list with its repeats is the quicker one to measure, and is an upper bound.
            small = self.fits(data_type)
            if not small:
                keys = materialize(keys, "reference-keys")
                small = fits_broadcast(keys)
            self._keys[name] = (keys, small)
        return self._keys[name]

    def fits(self, data_type: T.DataType) -> bool:
        """Whether the list with its repeats is small; unlike ``is_small`` it never copies the list."""
        name = data_type.simpleString()
        if name not in self._fits:
            self._fits[name] = fits_broadcast(self.frame.select(F.col(self.key).try_cast(data_type)))
        return self._fits[name]

    def in_place(self, data_type: T.DataType) -> bool:
        """Whether rows are checked where they are: neither shuffled nor read besides for it."""
        return self.fits(data_type) or self.bits(data_type) is not None

    def bits(self, data_type: T.DataType) -> DataFrame | None:
        """Whole-number keys as bits: ``__word`` and four longs for the 256 keys that share it.

        None if the keys are no whole numbers, the column neither such nor text, or the words not small.
        """
        if not isinstance(self.frame.schema[self.key].dataType, _WHOLE) or not isinstance(data_type, (*_WHOLE, T.StringType)):
            return None
        if not self._bits:
            self._bits.append(self._as_bits())
        return self._bits[0]

    def _as_bits(self) -> DataFrame | None:
        keys = self.frame.select(F.col(self.key).cast("long").alias("__ref")).filter("__ref IS NOT NULL")
        words = keys.withColumn("__word", _word("__ref"))
        width = 48 + 16 * (_PARTS + 1)
        # An estimate, so that keys far apart are not stored for nothing.
        if words.agg(F.approx_count_distinct("__word")).first()[0] * width > _setting(self.frame, "broadcastBytes", BROADCAST_BYTES):
            return None
        part, bit = _part("__ref"), F.expr("shiftleft(1L, CAST(__ref & 63 AS INT))")
        words = words.groupBy("__word").agg(*[F.bit_or(F.when(part == i, bit)).alias(f"__bits_{i}") for i in range(_PARTS)])
        words = materialize(words, "reference-bits")
        return words if fits_broadcast(words) else None

    def held(self, used: DataFrame, data_type: T.DataType, null_safe: bool) -> DataFrame:
        """Distinct keys as ``__ref`` that are among ``used`` (``__used``, few), without a copy of the list."""
        keys = self.frame.select(F.col(self.key).try_cast(data_type).alias("__ref"), F.col(self.key).isNull().alias("__null"))
        keys = keys.filter(F.col("__ref").isNotNull() | F.col("__null")).select("__ref")
        a, b = F.col("__ref"), F.col("__used")
        return keys.join(F.broadcast(used), a.eqNullSafe(b) if null_safe else a == b, "left_semi").distinct()

    def has_null(self) -> bool:
        return self._fact("null", lambda: not self.frame.filter(F.col(self.key).isNull()).isEmpty())

    def is_empty(self) -> bool:
        return self._fact("empty", self.frame.isEmpty)

    def _fact(self, name: str, look: Callable[[], bool]) -> bool:
        if name not in self._facts:
            self._facts[name] = look()
        return self._facts[name]


def _word(value: str) -> Column:
    return F.shiftright(value, (WORD_KEYS - 1).bit_length())


def _part(value: str) -> Column:
    return F.shiftright(value, 6).bitwiseAND(_PARTS - 1)


def _flag_by_bits(df: DataFrame, column: str, words: DataFrame, flag: str, null_known: bool) -> DataFrame:
    """Add ``flag`` by a broadcast of ``ReferenceList.bits``; text counts if it is written as the number is."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        number = value.try_cast("long")
        value = F.when(number.cast("string") == value, number)
    found = df.withColumn("__value", value.cast("long")).join(F.broadcast(words), _word("__value") == F.col("__word"), "left")
    held = F.coalesce(*[F.when(_part("__value") == i, F.col(f"__bits_{i}")) for i in range(_PARTS)], F.lit(0))
    known = F.coalesce(held.bitwiseAND(F.expr("shiftleft(1L, CAST(__value & 63 AS INT))")) != 0, F.lit(False))
    if null_known:
        known |= F.col(column).isNull()
    return found.withColumn(flag, known).drop("__value", *words.columns)


def flag_known(
    df: DataFrame,
    column: str,
    reference: ReferenceList,
    flag: str,
    *,
    null_safe: bool = True,
    stored: DataFrame | None = None,
    bits_first: bool = False,
) -> DataFrame:
    """Add boolean ``flag``: the value of ``column`` is in ``reference``.

    A large reference is not joined to the rows at once. The distinct values in use (reduced
    before the shuffle, so a hot key is one row) are measured first. If they are few, they are broadcast
    to the list, which stays where it is, and what it holds of them to the rows. Else whole-number keys become
    bits, 256 to a row, which are broadcast if they are small (``bits_first``: at once, without a look at the
    rows, for rows that are costly to read). Else they are looked up;
    if the unknown or the known ones are few these are broadcast, and the rows of ``df`` are never
    shuffled. A nearly unique column goes straight to the join. The values are read from ``stored``, the
    table that ``df`` was derived from (by default ``df`` itself).
    """
    stored = df if stored is None else stored
    data_type = df.schema[column].dataType
    unique = False
    if not reference.fits(data_type):
        words = reference.bits(data_type) if bits_first else None
        if words is not None:
            return _flag_by_bits(df, column, words, flag, null_safe and reference.has_null())
        used = stored.select(F.col(column).alias("__used"))
        n, distinct = used.agg(F.count(F.lit(1)), F.approx_count_distinct("__used")).first()
        unique = distinct > n / 2
        used = used.distinct()
        if not unique or fits_broadcast(used):
            used = materialize(used, "used-values")
            if fits_broadcast(used):
                few = materialize(reference.held(used, data_type, null_safe), "held-keys").withColumn("__matched", F.lit(True))
                a, b = F.col(column), F.col("__ref")
                marked = df.join(F.broadcast(few), a.eqNullSafe(b) if null_safe else a == b, "left")
                return marked.withColumn(flag, F.col("__matched").isNotNull()).drop("__ref", "__matched")
        words = None if bits_first else reference.bits(data_type)
        if words is not None:
            return _flag_by_bits(df, column, words, flag, null_safe and reference.has_null())
    keys, small = reference.keys(data_type), reference.is_small(data_type)
    if not small and not unique:
        a, b = F.col("__used"), F.col("__ref")
        listed = keys.withColumn("__listed", F.lit(True))
        looked_up = used.join(listed, a.eqNullSafe(b) if null_safe else a == b, "left")
        looked_up = materialize(looked_up.select("__used", "__listed"), "used-keys")
        for part, is_known in ((F.col("__listed").isNull(), F.col("__part").isNull()),
                               (F.col("__listed").isNotNull(), F.col("__part").isNotNull())):
            few = looked_up.filter(part).select("__used", F.lit(True).alias("__part"))
            if fits_broadcast(few):
                marked = df.join(F.broadcast(few), F.col(column).eqNullSafe(F.col("__used")), "left")
                return marked.withColumn(flag, is_known).drop("__used", "__part")
    marked = left_join_unique(
        df,
        keys.withColumn("__matched", F.lit(True)),
        [(column, "__ref")],
        null_safe=null_safe,
        small=small,
        stored=stored,
    )
    return marked.withColumn(flag, F.col("__matched").isNotNull()).drop("__matched")


def flag_not_in(
    df: DataFrame,
    column: str,
    reference: ReferenceList,
    flag: str,
    *,
    stored: DataFrame | None = None,
    bits_first: bool = False,
) -> DataFrame:
    """Add boolean ``flag``: SQL's ``column NOT IN (reference)`` is true.

    As in SQL, a null in the reference makes it true for no row, and an empty reference for every
    row; otherwise it is true for non-null values that are missing from the reference.
    """
    if reference.is_empty():
        return df.withColumn(flag, F.lit(True))
    if reference.has_null():
        return df.withColumn(flag, F.lit(False))
    known = flag_known(df, column, reference, "__in", null_safe=False, stored=stored, bits_first=bits_first)
    return known.withColumn(flag, F.col(column).isNotNull() & ~F.col("__in")).drop("__in")


def in_reference(df: DataFrame, column: str, reference: ReferenceList) -> DataFrame:
    """Rows whose ``column`` is in ``reference``; null matches a null entry."""
    return flag_known(df, column, reference, "__known_row", bits_first=True).filter("__known_row").drop("__known_row")


def not_in_reference(df: DataFrame, column: str, reference: ReferenceList) -> DataFrame:
    """Rows whose ``column`` is missing from ``reference``."""
    return flag_known(df, column, reference, "__known_row", bits_first=True).filter("NOT __known_row").drop("__known_row")
