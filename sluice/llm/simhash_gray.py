"""Near duplicates by SimHash, searched in a hierarchical index in Gray order.

A fingerprint has 64 bits. Two of them that differ in at most three bits agree in two of five
blocks of bits at least, so the upper nodes of the index are masked patterns: a choice of two
blocks and the bits in them. A link lies below one upper node at least, where the accumulated
difference is still zero. Inside a node the fingerprints are sorted by Gray rank and cut into
leaf groups; each group carries the bits that all its members share, and two groups whose shared
bits differ in more than three places are passed over as a whole.

The rows are range-partitioned by (node, Gray rank): a node of any size is spread over many tasks.
Leaf groups of one node in different places meet in a join of groups, not of rows. What leaves a
task is a spanning forest of the links found there, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sluice.llm.components import connected_components
from sluice.scratch import materialize

BITS = 3  # differing bits of linked fingerprints
WORDS = 3  # words of a shingle
SEED = 42
BLOCKS, KEPT = 5, 2  # of 5 blocks at least 2 are free of 3 differences
LEAF = 4096  # members of a leaf group
GROUP = 64  # members of a group inside a leaf
_CHUNK = 1 << 18  # shingles hashed at a time

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_BASE = (np.arange(8) * 256)[None, :]
_FINGERPRINTS = pa.schema([("id", pa.int64()), ("fp", pa.int64())])


def _hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data, SEED)


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """SimHash of a UTF-8 text: A-Z lowered, words between ASCII white space, shingles with repeats."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        return _hash(b" ".join(tokens))
    grams = map(_hash, map(b" ".join, zip(*(islice(tokens, k, None) for k in range(words)))))
    total, counts = len(tokens) - words + 1, np.zeros((8, 256), np.int64)
    for begin in range(0, total, _CHUNK):
        h = np.fromiter(grams, np.uint64, min(_CHUNK, total - begin)) if total - begin > _CHUNK else np.fromiter(grams, np.uint64)
        cells = h.astype("<u8").view(np.uint8).reshape(-1, 8) + _BYTE_BASE
        counts += np.bincount(cells.ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ _BYTE_BITS).ravel()
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, fp) for every row; fp is the unsigned fingerprint in a signed long.

    A null or blank text has fingerprint 0. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(fps.view(np.int64))], schema=_FINGERPRINTS)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def masks() -> list[int]:
    """The masks of the upper nodes: each choice of ``KEPT`` blocks of bits, as signed longs."""
    cuts = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:])]
    chosen = [sum(c) for c in combinations(blocks, KEPT)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def gray_rank(fp):
    """Column: the place of ``fp`` in Gray order, as a long that sorts like an unsigned number."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def _shared(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask and pattern of the bits that all members of a group (a row) share."""
    every, some = np.bitwise_and.reduce(groups, axis=1), np.bitwise_or.reduce(groups, axis=1)
    return ~(every ^ some), every


def _grouped(fps: np.ndarray) -> np.ndarray:
    """Rows of ``GROUP``; the last is filled up with its last member."""
    return np.concatenate([fps, np.repeat(fps[-1:], -len(fps) % GROUP)]).reshape(-1, GROUP)


def linked(left: np.ndarray, right: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within ``bits`` of two Gray-sorted lists; pairs of groups too far apart are not opened."""
    a, b = _grouped(left), _grouped(right)
    (mask_a, at_a), (mask_b, at_b) = _shared(a), _shared(b)
    for i in range(len(a)):
        apart = np.bitwise_count((at_a[i] ^ at_b) & mask_a[i] & mask_b)
        for near in np.array_split(np.flatnonzero(apart <= bits), 1 + len(b) // 64):
            if len(near):
                j, x, y = np.nonzero(np.bitwise_count(b[near][:, :, None] ^ a[i][None, None, :]) <= bits)
                yield a[i][y], b[near][j, x]


class _Forest:
    """Keeps the links that join two trees."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def _root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        keep = a != b
        for x, y in zip(a[keep].tolist(), b[keep].tolist()):
            p, q = self._root(x), self._root(y)
            if p != q:
                self.parent[max(p, q)] = min(p, q)
                self.links.append((x, y))

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        found = np.array(self.links, np.uint64).reshape(-1, 2)
        self.parent, self.links = {}, []
        return found[:, 0], found[:, 1]


_LEVEL = "mask int, pattern long, leaf long, a long, b long, shared long, members binary"
_LEVEL_ARROW = pa.schema([
    ("mask", pa.int32()), ("pattern", pa.int64()), ("leaf", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
    ("shared", pa.int64()), ("members", pa.binary()),
])


def _level(mask=(), pattern=(), leaf=(), a=(), b=(), shared=(), members=()) -> pa.RecordBatch:
    n = max(len(mask), len(a))
    columns = [mask, pattern, leaf, a, b, shared, members]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) if len(c) else pa.nulls(n, f.type) for c, f in zip(columns, _LEVEL_ARROW)], schema=_LEVEL_ARROW
    )


def _leaves(bits: int, leaf: int):
    """Over rows sorted by (mask, pattern, rank): links inside leaf groups, and the groups to be met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        rest: list[np.ndarray] | None = None
        first = True
        cut = False  # leaves of the node that the kept rest belongs to are out
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy() for i in range(4)]
            rows[3] = rows[3].view(np.uint64)
            if rest is not None:
                rows = [np.concatenate(x) for x in zip(rest, rows)]
            yield from _nodes(rows, forest, bits, first or cut, False, leaf)
            # The last node may go on; of a long one only the part short of a leaf is kept.
            starts = _starts(rows)
            begin = starts[-2]
            begin += (len(rows[0]) - begin) // leaf * leaf if len(rows[0]) - begin > leaf else 0
            cut = begin > starts[-2] or (cut and len(starts) == 2)
            rest = [x[begin:] for x in rows]
            first = first and len(starts) == 2
            a, b = forest.take()
            if len(a):
                yield _level(a=a.view(np.int64), b=b.view(np.int64))
        if rest is not None and len(rest[0]):
            yield from _nodes(rest, forest, bits, first or cut, True, leaf)
            a, b = forest.take()
            if len(a):
                yield _level(a=a.view(np.int64), b=b.view(np.int64))

    return run


def _starts(rows: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(rows[0]), bool)
    new[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
    return np.append(np.flatnonzero(new), len(new))


def _nodes(rows, forest: _Forest, bits: int, first: bool, last: bool, leaf: int) -> Iterator[pa.RecordBatch]:
    """Search the complete nodes of ``rows``; with ``last`` its final one too.

    The first and the final node of a task, and those longer than a leaf, can have members elsewhere:
    their leaf groups go out. So do those of the ``first`` node of ``rows`` if others of its leaves are out.
    """
    mask, pattern, rank, fp = rows
    starts = _starts(rows)
    sizes = np.diff(starts)
    done = np.ones(len(sizes), bool)
    done[-1] = last
    # Small nodes side by side: compare each row with the k-th after it in the same node.
    node = np.repeat(np.arange(len(sizes)), sizes)
    small = np.where(done & (sizes <= GROUP // 2), sizes, 0)
    for k in range(1, int(small.max(initial=0))):
        i = np.flatnonzero((node[k:] == node[:-k]) & (small[node[:-k]] > 0))
        i = i[np.bitwise_count(fp[i] ^ fp[i + k]) <= bits]
        forest.add(fp[i], fp[i + k])
    open_ends = {0} if first else set()
    if last:
        open_ends.add(len(sizes) - 1)
    for n in np.flatnonzero((sizes > GROUP // 2) | np.isin(np.arange(len(sizes)), list(open_ends))):
        begin, end = starts[n], starts[n + 1]
        if not done[n]:
            end = begin + (end - begin) // leaf * leaf if end - begin > leaf else begin
        whole = done[n] and sizes[n] <= leaf and n not in open_ends
        for at in range(begin, end, leaf):
            members = fp[at : min(end, at + leaf)]
            if sizes[n] > GROUP // 2 or not done[n]:  # smaller ones are done, but not the short last leaf of a long one
                for x, y in linked(members, members, bits):
                    forest.add(x, y)
            if not whole:
                shared, every = _shared(members[None, :])
                yield _level(
                    mask=[int(mask[at])], pattern=[int(pattern[at])], leaf=[int(rank[at])], a=every.view(np.int64),
                    shared=shared.view(np.int64), members=[members.astype("<u8").tobytes()],
                )


def _meet(bits: int):
    """Links between two leaf groups of one node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1)):
                forest = _Forest()
                for x, y in linked(*(np.frombuffer(m.as_py(), "<u8") for m in (left, right)), bits):
                    forest.add(x, y)
                a, b = forest.take()
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def near_links(fps: DataFrame, bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """``fps`` (fp: long, distinct) -> (a, b): links that connect all fingerprints within ``bits``.

    Any two fingerprints at ``bits`` (at most 3) or fewer differences are connected by them; every
    link is itself within ``bits``.
    """
    if bits > BLOCKS - KEPT:
        raise ValueError(f"the masks find up to {BLOCKS - KEPT} differing bits")
    nodes = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("pattern")) for i, m in enumerate(masks())])
    placed = fps.select("fp", F.explode(nodes).alias("n")).select("n.mask", "n.pattern", gray_rank(F.col("fp")).alias("rank"), "fp")
    order = ["mask", "pattern", "rank"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    level = materialize(placed.mapInArrow(_leaves(bits, leaf), _LEVEL), "leaves")
    leaves = level.filter("members IS NOT NULL")
    other = leaves.select("mask", "pattern", *[F.col(c).alias(f"other_{c}") for c in ("leaf", "a", "shared", "members")])
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("other_a")).bitwiseAND(F.col("shared")).bitwiseAND(F.col("other_shared")))
    pairs = leaves.join(other, ["mask", "pattern"]).filter((F.col("leaf") < F.col("other_leaf")) & (apart <= bits))
    across = pairs.select("members", "other_members").mapInArrow(_meet(bits), "a long, b long")
    return level.filter("members IS NULL").select("a", "b").unionAll(across)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, bits: int = BITS
) -> DataFrame:
    """(id, fp, component) for every row of ``docs``.

    ``component`` is the smallest id that links of at most ``bits`` differing bits reach, the row's
    own included. Null and blank texts have fingerprint 0 and link like any other; repeated rows and
    ids stay as they are; a row with a null id has the component of the others of its group, and
    null if there are none. An empty table gives no rows.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = connected_components(near_links(nodes.select("fp"), bits))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialize(rooted, "rooted-fingerprints")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    classes = rooted.join(least, "root").select("fp", "component")
    return rows.join(classes, "fp").select("id", "fp", "component")
