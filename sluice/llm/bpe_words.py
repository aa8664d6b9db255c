"""Byte-level BPE over the distinct words of the corpus.

A block of documents (what one task reads, cut at ``BLOCK_CHARS``) numbers its distinct pre-tokens; a document
is then the list of those numbers in the order of its positions. The texts are cut into pre-tokens once for the
words and once for the positions, which takes less disk than to store the positions besides shuffling them. Only the distinct pre-tokens of a block are shuffled,
by a hash of the word, so that one task sees every copy of a word and encodes it once; the ids go
back to the blocks, where each document is put together again by position. Rows carry packed lists
of words or numbers in place of one word each: the shuffles move what is distinct, and no key is
hot, as a block sends each word once.

Decoding looks every id up in the table of token bytes, whose size the vocabulary file bounds.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from sluice.llm.packing import expand, numbers as unpacked, squeeze

BLOCK_CHARS = 8_000_000  # characters after which a block is closed
_CACHE_WORDS = 300_000  # encoded words that a task remembers at a time
_TOKENS = 100_000  # pre-tokens held as Python strings at a time
_IDS = 500_000  # ids after which a batch of decoded rows is closed
# White space before a space, taken widely: there a text is not cut at its spaces.
_SPACES = r"[\s\v\x1c-\x1f\x{85}\p{Z}] "
_SHORT = 64  # bytes up to which a word is merged by plain scans

_ROW = "block long, kind int, bucket int, id long, payload binary"
_ROW_ARROW = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("id", pa.int64()), ("payload", pa.binary())])
_WORDS, _DOC = 0, 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id, from a file of lines with base64 bytes and a rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: join the neighbours of the lowest rank, leftmost first, while any has one."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > _SHORT:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = None, 0
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and linked parts, so that long runs cost n log n."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            rank = ranks.get(word[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue
        end[i], after[i], alive[j] = stop, after[j], False
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROW_ARROW)], schema=_ROW_ARROW)


def _found(units: list[str], find) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct pre-tokens of all units, the place of each pre-token among them, and how many a unit has."""
    held, parts, sizes = [], [], np.empty(len(units), np.int64)
    for k, unit in enumerate(units):
        tokens = find(unit)
        sizes[k] = len(tokens)
        held += tokens
        if len(held) >= _TOKENS:
            parts.append(pa.array(held, pa.large_string()))
            held = []
    parts.append(pa.array(held, pa.large_string()))
    coded = pa.chunked_array(parts).dictionary_encode().combine_chunks()
    return coded.dictionary, coded.indices.to_numpy(), sizes


def _cut(texts: list[str], find, spaced: bool) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct pre-tokens of ``texts``, and of each text the places of its own among them.

    A text is cut at its spaces first, unless white space stands before one. Each distinct piece behind a
    space is matched once; what stands first in a text, or is not cut, is matched as it is.
    """
    values = pa.array(texts, pa.large_string())
    whole = pc.match_substring_regex(values, _SPACES).to_numpy(zero_copy_only=False) if spaced else np.ones(len(texts), bool)
    split = pc.split_pattern(values.filter(pa.array(~whole)), " ")
    begins = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
    coded = split.flatten().dictionary_encode()
    codes, pieces = coded.indices.to_numpy(), coded.dictionary
    behind = np.ones(len(codes), bool)
    behind[begins] = False
    used = np.unique(codes[behind])
    units = [" " + p for p in pieces.take(pa.array(used)).to_pylist()]
    firsts = len(units) + np.arange(len(begins))
    units += pieces.take(pa.array(codes[begins])).to_pylist()
    alone = len(units) + np.arange(int(whole.sum()))
    units += [texts[k] for k in np.flatnonzero(whole).tolist()]

    del values, coded, pieces
    words, tokens, sizes = _found(units, find)
    del units
    starts = np.cumsum(sizes) - sizes

    # The units of each text in order: its first piece and those behind it, or the whole of it.
    counts = np.ones(len(texts), np.int64)
    counts[~whole] = np.diff(split.offsets.to_numpy())
    places = np.cumsum(counts) - counts
    unit = np.empty(int(counts.sum()), np.int64)
    inside = np.repeat(~whole, counts)
    of_pieces = np.empty(len(codes), np.int64)
    of_pieces[behind] = np.searchsorted(used, codes[behind])
    of_pieces[begins] = firsts
    unit[inside], unit[~inside] = of_pieces, alone
    del codes, of_pieces
    numbers = _gathered(tokens, starts[unit], sizes[unit])
    ends = np.cumsum(np.add.reduceat(sizes[unit], places))
    return words, np.split(numbers, ends[:-1])


def _split(pattern: str, buckets: int, kind: int, spaced: bool):
    """Documents -> the words of each block by bucket, or their positions as numbers of those words.

    Both kinds see the same blocks: these follow from the texts in the order of the input alone.
    """

    def words_of(block: int, words: pa.Array) -> Iterator[tuple]:
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words.cast(pa.large_binary()).to_pylist()), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        sorted_words = words.take(pa.array(order))
        _, offsets, data = sorted_words.buffers()
        offsets, data = np.frombuffer(offsets, np.int64)[: len(words) + 1], memoryview(data or b"")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[b], cuts[b + 1])
            ends = offsets[cuts[b] : cuts[b + 1] + 1]
            yield block, _WORDS, int(b), None, squeeze(order[own], np.diff(ends), bytes(data[ends[0] : ends[-1]]))

    def docs_of(block: int, ids: list, numbers: list[np.ndarray]) -> Iterator[tuple]:
        for doc, found in zip(ids, numbers):
            yield block, _DOC, None, doc, squeeze(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        block, ids, texts, chars = None, [], [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            words, numbers = _cut(texts, find, spaced)
            out, held = [], 0
            for row in words_of(block, words) if kind == _WORDS else docs_of(block, ids, numbers):
                out.append(row)
                held += len(row[-1])
                if len(out) >= 5_000 or held > 8_000_000:
                    yield _batch(out)
                    out, held = [], 0
            if out:
                yield _batch(out)
            pa.default_memory_pool().release_unused()

        for batch in batches:
            if block is None and batch.num_rows:
                block = batch.column(2)[0].as_py() << 32
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc.as_py())
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= BLOCK_CHARS:
                    yield from rows()
                    block, ids, texts, chars = block + 1, [], [], 0
        if ids:
            yield from rows()

    return run


def _encode_words(ranks):
    """Words of one bucket from all blocks -> their ids, each distinct word merged once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = ranks.value, {}
        for batch in batches:
            rows = []
            for block, bucket, payload in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(4)):
                numbers, lengths, data = expand(payload.as_py())
                ends = np.cumsum(unpacked(lengths)).tolist()
                found, begin = [], 0
                for end in ends:
                    word, begin = data[begin:end], end
                    ids = known.get(word)
                    if ids is None:
                        known[word] = ids = merge(word, table)
                    found.append(ids)
                counts = np.fromiter(map(len, found), np.uint32, len(found))
                flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(counts.sum()))
                rows.append((block, _WORDS, bucket, None, squeeze(unpacked(numbers), counts, flat)))
                if len(known) > _CACHE_WORDS:
                    known = {}
            if rows:
                yield _batch(rows)

    return run


_ENCODED_ARROW = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[start : start + size]`` for each pair, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    places = np.repeat(starts - (ends - sizes), sizes)
    places += np.arange(total)
    return flat[places]


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by block, a block's words before its documents -> ids of each document."""
    block, replies, words = None, [], None
    for batch in batches:
        docs, lists = [], []
        for at, kind, doc, payload in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), batch.column(4)):
            if at != block:
                block, replies, words = at, [], None
            parts = [unpacked(p) for p in expand(payload.as_py())]
            if kind == _WORDS:
                replies.append(parts)
                continue
            if words is None:
                if replies:
                    numbers, counts, flat = (np.concatenate(x) for x in zip(*replies))
                    sizes, starts = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
                    sizes[numbers] = counts
                    starts[numbers] = np.cumsum(counts, dtype=np.int64) - counts
                    words = flat.astype(np.int32), starts, sizes
                else:
                    words = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
                replies = []
            flat, starts, sizes = words
            docs.append(doc)
            lists.append(_gathered(flat, starts[parts[0]], sizes[parts[0]]))
            if sum(map(len, lists[-64:])) > 1_000_000 or len(lists) >= 2_000:
                yield _lists(docs, lists)
                docs, lists = [], []
        if docs:
            yield _lists(docs, lists)


def _lists(docs: list, lists: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), ids], schema=_ENCODED_ARROW)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", spaced: bool = True) -> DataFrame:
    """(id, ids: array<int>) for every row: the ids of its whole text, without special tokens.

    ``ranks_path`` is read by the driver; ``pattern`` cuts a text into pre-tokens. ``spaced`` says that no
    pre-token holds a space behind a character that is no white space, as is usual: a text is then cut before
    single spaces first, and the pre-tokens of what lies between are found once a block. A null or empty
    text has no ids. Repeated rows, equal ids and null ids give a row each; an empty table gives no
    rows. Other columns are not read. ``docs`` is read twice and has to give the same rows in the same order,
    as files do; store what does not.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    buckets = max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Numbers the parts of the input; the number of a task would count those of the other branch too.
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("part"))
    words = rows.mapInArrow(_split(pattern, buckets, _WORDS, spaced), _ROW).repartition("bucket").mapInArrow(_encode_words(ranks), _ROW)
    parts = words.unionAll(rows.mapInArrow(_split(pattern, buckets, _DOC, spaced), _ROW))
    together = parts.repartition("block").sortWithinPartitions("block", "kind")
    return together.mapInArrow(_reassemble, "id long, ids array<int>")


def _slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in order, cut where the ids in column ``at`` pass another ``_IDS``."""
    ends = np.cumsum(np.diff(batch.column(at).offsets.to_numpy()), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // _IDS)) + 1
    for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(begin, end - begin)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", name: str = "data") -> DataFrame:
    """Add ``name`` (binary): the bytes of the ids in ``ids_col``. A null list gives null, an empty one no bytes."""
    table = {i: t for t, i in read_ranks(ranks_path).items()}
    shared = encoded.sparkSession.sparkContext.broadcast(table)
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            for rows in _slices(batch, at):
                lists = rows.column(at)
                data = [None if x is None else b"".join(map(token, x)) for x in (v.as_py() if not v.is_valid else v.values.to_numpy().tolist() for v in lists)]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(data, pa.binary())], names=[*rows.schema.names, name])
        pa.default_memory_pool().release_unused()

    return encoded.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in encoded.schema)}, `{name}` binary")
