"""Document fingerprints: a digest of bucket quartiles.

The hashed byte triplets of a text are counted in 128 buckets. A digest holds, for each bucket, which
quarter of the counts its count belongs to, the quartiles in relation to each other, and the length on
a logarithmic scale. Two digests are compared by a bounded difference score, so that texts that
share most of their parts have close digests, whatever their order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

BUCKETS = 128
SPAN = 5  # bytes a triplet is taken from
FARTHEST = 400  # difference from which digests count as unlike
_CHUNK = 1 << 20  # bytes counted at a time

# Places of the second and third byte of a triplet, the first being 0, and its salt.
_TRIPLETS = ((1, 2, 2), (1, 3, 3), (2, 3, 5), (2, 4, 7), (1, 4, 11), (3, 4, 13))


def triplet_counts(data: bytes) -> np.ndarray:
    """Counts of the hashed triplets of a text by bucket; triplets that pass its end do not count."""
    counts = np.zeros(BUCKETS, np.int64)
    every = np.frombuffer(data, np.uint8)
    for begin in range(0, len(every), _CHUNK):
        part = every[begin : begin + _CHUNK + SPAN - 1].astype(np.uint32)
        for second, third, salt in _TRIPLETS:
            n = min(_CHUNK, len(part) - third)
            if n > 0:
                value = part[:n] << np.uint32(16) | part[second : second + n] << np.uint32(8) | part[third : third + n]
                value = (value + np.uint32(salt << 24)) * np.uint32(2654435761)
                counts += np.bincount(value >> np.uint32(25), minlength=BUCKETS)
    return counts


def digest(data: bytes) -> str:
    """Two hex digits of length, two of quartile ratios, 64 of buckets. An empty text has zeros only."""
    counts = triplet_counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]].tolist()
    levels = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = levels.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    length = min(255, round(12 * math.log2(len(data) + 1)))
    ratios = (16 * (q1 * 15 // q3) + q2 * 15 // q3) if q3 else 0
    return bytes([length, ratios, *packed.tolist()]).hex()


def difference(a: str, b: str) -> int:
    """Sum of the differences in length, quartile ratios and buckets; opposite quarters count double."""
    x, y = np.frombuffer(bytes.fromhex(a), np.uint8).astype(np.int64), np.frombuffer(bytes.fromhex(b), np.uint8).astype(np.int64)
    apart = np.abs((x[2:, None] >> np.array([6, 4, 2, 0]) & 3) - (y[2:, None] >> np.array([6, 4, 2, 0]) & 3))
    ratios = abs((x[1] >> 4) - (y[1] >> 4)) + abs((x[1] & 15) - (y[1] & 15))
    return int(abs(x[0] - y[0]) + 4 * ratios + np.where(apart == 3, 6, apart).sum())


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 from a difference of ``FARTHEST`` on."""
    return 1 - min(difference(a, b), FARTHEST) / FARTHEST


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) for every row, over its whole text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            found = [digest(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(found, pa.string())], names=["id", "n_chars", "fingerprint"]
            )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, n_chars long, fingerprint string")


_EDITED = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(range, guest, id, body): every row by ranges of ids, and in each range the first row of the next one.

    ``body`` is the compressed text. The range bounds are ids of the table, so the rows with a bound as
    id are copied to the range before as guests, those with the smallest id to the last range.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.array(*[F.lit(k / ranges) for k in range(1, ranges)]) if ranges > 1 else F.array(F.lit(0.0))
    # One value per range comes to the driver.
    bounds, least, nulls = rows.agg(F.percentile_approx("id", share, 10 * ranges), F.min("id"), F.count_if(F.col("id").isNull())).first()
    bounds = sorted({b for b in bounds or [] if b > least})
    last = len(bounds)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        at = np.array(bounds, np.int64)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = []
            for k, (doc, text) in enumerate(zip(ids, batch.column(1))):
                body = pack((text.as_py() or "").encode())
                mine = int(np.searchsorted(at, doc, "right")) if doc is not None else 0
                out.append((mine, False, doc, body))
                if mine and doc == bounds[mine - 1]:
                    out.append((mine - 1, True, doc, body))
                if doc is None or (doc == least and not nulls):
                    out.append((last, True, doc, body))
                if len(out) >= 1_000 or k == len(ids) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.bool_(), pa.int64(), pa.binary()))], names=["range", "guest", "id", "body"]
                    )
                    out = []

    placed = rows.mapInArrow(place, "range int, guest boolean, id long, body binary")
    return placed.repartition("range").sortWithinPartitions("range", "guest", "id", "body")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are.

    Edited: the last half of the code points (rounded down) gives way to as many from the start of the
    next document, or all it has; next by id, after the last the first. Null texts count as empty, null
    ids come before all others, rows with equal ids follow each other in the order of their compressed
    texts. A table of one row is its own next; an empty one gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        before = None
        for batch in batches:
            out = []
            for at, guest, doc, body in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                if guest and (before is None or before[0] != at or before[1]):
                    before = (at, True) if before is None or before[0] != at else before
                    continue
                text = unpack(body.as_py()).decode()
                row = (at, guest, doc, text, digest(text.encode()))
                if before is not None and before[0] == at and not before[1]:
                    _, _, own, left, mine = before
                    half = len(left) // 2
                    edited = (left[: len(left) - half] + text[:half]).encode()
                    theirs = digest(edited)
                    out.append((own, len(left), hashlib.sha256(edited).hexdigest(), mine, theirs, likeness(mine, theirs), likeness(mine, row[4])))
                before = row
            if out:
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                names = [c.split()[0] for c in _EDITED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return with_next(docs, id_col, text_col).mapInArrow(run, _EDITED)
