"""Near duplicates by the similarity of their word shingles.

Texts whose sets of shingles have a Jaccard similarity of ``SIMILAR`` or more are linked, and every link is
checked on the whole sets. The candidates come from the SimHash index of ``simhash_gray`` first: texts of one
fingerprint, and the links that the index in Gray order finds between fingerprints. Pairs at ``SIMILAR`` can differ
in more bits than its masks find, so what it leaves apart is sought by prefixes, which miss no pair: if all sets are
in one order, two similar sets share one of their first shingles, the smaller one among fewer of them. The places
and sizes at the first shingle that a pair shares bound what it can share in all, and so do bitmaps of parities.
Shingles that are frequent in a sample come last in the order, so that common passages bring few sets together; the
sample decides on the order only, not on what is found. Rows that share such a shingle are first compared with the
least of them, then in rounds with one drawn for each shingle, and what is not in one component then with each
other, so that a large group of near copies costs few pairs.

Of a text only its fingerprint, a hash of its set, bitmaps and its first shingles are stored; equal sets are one class, and
the sets themselves are made again, from one text of a class, for those classes that are in a candidate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import islice
from operator import add, and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sluice.llm import simhash_gray
from sluice.llm.components import connected_components
from sluice.operators.lookups import fits_broadcast
from sluice.scratch import materialize

WORDS = 5  # words of a shingle
SIMILAR = 0.8  # Jaccard similarity of linked texts
SAMPLE = 10_000  # texts, about, from which frequent shingles are learnt
FREQUENT = 1 << 16  # shingles that come last in the order, at most
DRAWN = 1  # rounds in which rows are compared with one drawn from those that share a shingle
PLANES = 4  # longs of the short bitmap of parities
_SLACK = 1e-6  # a bound that rounding puts above a whole number is that number
_PAIRS = 250  # pairs of sets, or texts of sets, sent to a Python worker at a time

_HASHES = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("node", pa.int64()), ("fp", pa.int64()), ("n", pa.int64()), ("planes", pa.list_(pa.int64())), ("bitmap", pa.binary()), ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("node", pa.int64()), ("members", pa.binary())])


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles: A-Z lowered, words between ASCII white space; of fewer words, all as one."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    grams = zip(*(islice(tokens, k, None) for k in range(words))) if len(tokens) >= words else [tokens]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(g)) for g in grams), np.uint64))


def bands(first: np.ndarray) -> list[int]:
    """The keys by which a set is found: its first shingles in the common order, as signed longs."""
    return first.view(np.int64).tolist()


def _first(members: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], similar: float) -> np.ndarray:
    """The first of ``members`` (rare ones, then by hash), of which a similar set of any size shares one."""
    known, counts = frequent
    often = np.zeros(len(members), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, members), len(known) - 1)
        often = np.where(known[at] == members, counts[at], 0)
    return members[np.lexsort((members, often))][: len(members) - math.ceil(similar * len(members) - _SLACK) + 1]


def _packed(found: list[np.ndarray]) -> list[bytes]:
    return [x.astype("<u8").tobytes() for x in found]


def parities(members: np.ndarray, bits: int) -> bytes:
    """A bit for each of ``bits`` classes of shingles: whether their number is odd.

    The bitmaps of two sets differ in no more bits than there are shingles that only one of them has.
    """
    odd = np.bincount((members >> np.uint64(32)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _bitmap(members: np.ndarray) -> bytes:
    """A bit or two for each shingle, so that long sets are told apart too; a power of two."""
    return parities(members, max(64, 1 << (len(members) - 1).bit_length()))


def _frequent(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that several texts of a sample have, and in how many of them they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for at in range(0, len(texts), 100):
                found = [shingles(t.as_py(), words) for t in texts[at : at + 100]]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["h"])

    step = max(1, texts.count() // SAMPLE)
    sample = texts.filter(F.pmod(F.xxhash64("row"), F.lit(step)) == 0).select("text")
    counts = sample.mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # A bounded list.
    found = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    known = found.column(0).to_numpy().view(np.uint64)
    order = np.argsort(known)
    return known[order], found.column(1).to_numpy()[order]


def _hashes(words: int, similar: float, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for at in range(0, len(texts), 500):
                found = [shingles(t.as_py(), words) for t in texts[at : at + 500]]
                nodes = [xxhash.xxh64_intdigest(d) - (1 << 63) for d in _packed(found)]
                fps = np.fromiter((simhash_gray.fingerprint(t.as_py()) for t in texts[at : at + 500]), np.uint64, len(nodes)).view(np.int64)
                first = [bands(_first(x, frequent.value, similar)) for x in found]
                planes = [np.frombuffer(parities(x, 64 * PLANES), "<i8").tolist() for x in found]
                columns = [batch.column(0)[at : at + 500], batch.column(2)[at : at + 500], nodes, fps, [len(x) for x in found], planes, [_bitmap(x) for x in found], first]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _HASHES)], schema=_HASHES)
        pa.default_memory_pool().release_unused()

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for at in range(0, len(texts), 500):
                data = _packed([shingles(t.as_py(), words) for t in texts[at : at + 500]])
                if [xxhash.xxh64_intdigest(d) - (1 << 63) for d in data] != batch.column(0)[at : at + 500].to_pylist():
                    raise ValueError("the documents were not the same when they were read again")
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + 500], pa.array(data, pa.binary())], schema=_SETS)
        pa.default_memory_pool().release_unused()

    return run


def _checked(similar: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(m.as_buffer(), "<u8") for m in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similar * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _near(similar: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
                short, long = sorted((np.frombuffer(x.as_buffer(), np.uint8) for x in (left, right)), key=len)
                only = np.bitwise_count(short ^ np.bitwise_xor.reduce(long.reshape(-1, len(short)))).sum()
                keep.append(only <= n + m - 2 * math.ceil(similar / (1 + similar) * (n + m) - _SLACK))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _made_again(texts: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(node, members) for the nodes of ``pairs``."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = materialize(nodes.select("node", "row").join(wanted, "node", "left_semi"), "sampled-texts")
    sets = texts.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "row").select("node", "text")
    return materialize(sets.mapInArrow(_sets(words), "node long, members binary"), "shingles", arrow_rows=_PAIRS)


def _links(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, words: int, similar: float) -> DataFrame:
    """The pairs (a, b) that are similar; the sets are made again only where the bitmaps do not exclude it."""
    pairs = materialize(pairs.distinct(), "pairs")
    for end in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("bitmap").alias(f"bitmap_{end}")), end)
    pairs = pairs.select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b").mapInArrow(_near(similar), "a long, b long")
    pairs = materialize(pairs, "near-pairs", arrow_rows=_PAIRS)
    sets = _made_again(texts, nodes, pairs, words)
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    return materialize(both.select("a", "b", "left", "right").mapInArrow(_checked(similar), "a long, b long"), "links", arrow_rows=_PAIRS)


def _indexed(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that the index of fingerprints links: one node for each fingerprint, and the others of it."""
    heads = materialize(rows.groupBy("fp").agg(F.min("node").alias("head")), "distinct-fingerprints")
    same = rows.select("node", "fp").distinct().join(heads, "fp").select(F.col("node").alias("a"), F.col("head").alias("b"))
    ends = [heads.select(F.col("fp").alias(c), F.col("head").alias(f"head_{c}")) for c in "ab"]
    links = simhash_gray.near_links(heads.select("fp")).join(ends[0], "a").join(ends[1], "b")
    pairs = same.unionAll(links.select(F.greatest("head_a", "head_b").alias("a"), F.least("head_a", "head_b").alias("b")))
    return materialize(pairs.filter("a <> b").distinct(), "index-candidates")


def _shared(similar: float, n, m):
    """Column: the least number of shingles that similar sets of ``n`` and ``m`` share."""
    return F.ceil(F.lit(similar / (1 + similar)) * (n + m) - _SLACK)


def _possible(similar: float, pos="pos", n="n", other_pos="other_pos", other_n="other_n"):
    """Column: sets of these sizes whose first shared shingle has these places can be similar."""
    pos, n, other_pos, other_n = map(F.col, (pos, n, other_pos, other_n))
    return F.least(n - pos, other_n - other_pos) >= _shared(similar, n, other_n)


def _short(similar: float):
    """Column: the place is among the first shingles of which sets that are no smaller share one."""
    return F.col("pos") <= F.col("n") - _shared(similar, F.col("n"), F.col("n"))


def _prefixes(rows: DataFrame, similar: float) -> DataFrame:
    """(token, node, n, pos, least): the first shingles that nodes share, and the least of the nodes."""
    keys = rows.select("node", "n", F.posexplode("bands").alias("pos", "token"))
    ends = keys.groupBy("token").agg(F.min("node").alias("least"), F.max("node").alias("most"), F.max(_short(similar).cast("int")).alias("short"))
    shared = materialize(ends.filter("least < most AND short = 1").select("token", "least"), "shared-shingles")
    return materialize(keys.join(shared, "token").distinct(), "prefixes")


def _stars(prefixes: DataFrame, similar: float) -> DataFrame:
    """Pairs (a, b) of a node and the least one that shares a first shingle with it."""
    heads = prefixes.filter("node = least").select("token", F.col("n").alias("other_n"), F.col("pos").alias("other_pos"))
    pairs = prefixes.filter("node <> least").join(heads, "token").filter(_possible(similar))
    return materialize(pairs.select(F.col("node").alias("a"), F.col("least").alias("b")).distinct(), "star-candidates")


def _mixed(prefixes: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of ``prefixes`` whose shingle is in several components, with root and bitmap."""
    placed = prefixes.join(roots, "node", "left").select("token", "node", "n", "pos", F.coalesce("root", "node").alias("root"))
    placed = materialize(placed, "placed")
    parts = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("token")
    return materialize(placed.join(parts, "token").join(nodes.select("node", *[f"plane_{i}" for i in range(PLANES)]), "node"), "mixed-shingles")


def _others(rows: DataFrame) -> DataFrame:
    return rows.select("token", *[F.col(c).alias(f"other_{c}") for c in rows.columns if c != "token"])


def _pairs(left: DataFrame, right: DataFrame, similar: float, *conditions) -> DataFrame:
    """Pairs (a, b) of nodes that share a shingle, can be similar and are not in one component."""
    only = reduce(add, [F.bit_count(F.col(f"plane_{i}").bitwiseXOR(F.col(f"other_plane_{i}"))) for i in range(PLANES)])
    n, m = F.col("n"), F.col("other_n")
    possible = _possible(similar) & (only <= n + m - 2 * _shared(similar, n, m)) & (F.col("root") != F.col("other_root"))
    pairs = left.join(_others(right), "token").filter(reduce(and_, conditions, possible))
    return materialize(pairs.select(F.greatest("node", "other_node").alias("a"), F.least("node", "other_node").alias("b")).distinct(), "apart")


def _drawn(mixed: DataFrame, similar: float, salt: int) -> DataFrame:
    """Pairs of the rows that share a shingle with one of them."""
    row = F.struct(*[c for c in mixed.columns if c != "token"])
    heads = mixed.groupBy("token").agg(F.min_by(row, F.xxhash64("token", "node", F.lit(salt))).alias("head")).select("token", "head.*")
    return _pairs(mixed, materialize(heads, "drawn"), similar)


def _apart(mixed: DataFrame, similar: float) -> DataFrame:
    """Pairs of all rows that share a shingle; the smaller set, or the lesser node, is found by fewer of them."""
    larger = F.struct("n", "node") > F.struct("other_n", "other_node")
    return _pairs(mixed, mixed.filter(_short(similar)), similar, larger)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similar: float = SIMILAR
) -> DataFrame:
    """(id, component) for every row of ``docs``; ``component`` is the same for rows that links connect.

    Null and blank texts have no shingles and are copies of each other. A text of fewer words than a shingle is
    one shingle, a text of any length is read whole. Repeated rows and null ids give a row each, an empty table
    none. Other columns are not read, whatever their names. ``docs`` is read several times and has to give the same rows
    in the same order, as files do; store what does not (that it did is checked).
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(texts, words))
    layout = "id long, row long, node long, fp long, n long, planes array<long>, bitmap binary, bands array<long>"
    rows = materialize(texts.mapInArrow(_hashes(words, similar, frequent), layout), "shingle-hashes", arrow_rows=_PAIRS)
    planes = [F.min(F.col("planes")[i]).alias(f"plane_{i}") for i in range(PLANES)]
    nodes = rows.groupBy("node").agg(F.min("row").alias("row"), F.min("n").alias("n"), *planes, F.min("bitmap").alias("bitmap"))
    nodes = materialize(nodes, "nodes")
    prefixes = _prefixes(rows, similar)
    links = _links(_indexed(rows), texts, nodes, words, similar)
    # Pairs that the index has connected are not compared again.
    roots, stars = materialize(connected_components(links), "index-roots"), _stars(prefixes, similar)
    for end in "ab":
        stars = stars.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    stars = stars.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    links = links.unionAll(_links(stars, texts, nodes, words, similar))
    for salt in range(DRAWN + 1):
        mixed = _mixed(prefixes, nodes, connected_components(links))
        pairs = _drawn(mixed, similar, salt) if salt < DRAWN else _apart(mixed, similar)
        links = links.unionAll(_links(pairs, texts, nodes, words, similar))
    roots = connected_components(links)
    return rows.select("id", "node").join(roots, "node", "left").select("id", F.coalesce("root", "node").alias("component"))
