"""Removal of repeated passages by recompression.

Rounds name token runs and then pairs of neighbouring symbols. A name is a 64-bit hash of what it
stands for, so that tasks agree on all names without a shuffle. Whether two neighbours are paired
depends on them alone: a hash of each puts it on the left or the right side in that round. So the words
that a symbol depends on are known (its context), and a symbol whose context lies in a window of 50
words is found in every other place of that window.

Each window takes one of its own symbols as anchor: the one of the most words, then of the smallest
hash. Neighbouring windows with one anchor make a block. Only blocks, about one for fifteen words, are
shuffled:

* a symbol that anchors in one document only reveals nothing;
* if all blocks of a symbol are equal, those outside its first document are repeats;
* else equal blocks are looked up, and for the first of each kind its single windows, by their hash.

A window without a symbol of its own (inside a long run) is its own anchor, so nothing is left out.
Symbol and window are two independent 64-bit hashes of which both have to agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from sluice.scratch import materialize

WINDOW = 50  # words
ROUNDS = 5  # rounds of pairs
_PIECE = 500_000  # words parsed at a time; a longer text is cut into pieces that overlap by a window
_CACHE_WORDS = 500_000  # words whose hashes a task remembers at a time

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _times(number: int) -> np.uint64:
    return np.uint64(number * 0xD6E8FEB86659FD93 % (1 << 64))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class _Spans:
    """Hashes of any span of a word sequence, whatever stands before it."""

    _powers = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __init__(self, hashes: np.ndarray) -> None:
        n = len(hashes) + 1
        if len(self._powers[0]) < n:
            one = np.ones(1, np.uint64)
            size = max(n, 2 * len(self._powers[0]))
            type(self)._powers = tuple(np.multiply.accumulate(np.concatenate([one, np.full(size - 1, b)])) for b in (_BASE, _INVERSE))
        self.up = self._powers[0]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self._powers[1][: n - 1], dtype=np.uint64)])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[begin]) * self.up[begin] + (end - begin).astype(np.uint64) * _times(7))


class Parse:
    """Symbols of several word sequences side by side, with the words that each depends on.

    ``first`` and ``past`` bound the context of a symbol; at the end of a sequence it reaches over it.
    """

    def __init__(self, hashes: np.ndarray, sizes: np.ndarray, rounds: int = ROUNDS) -> None:
        ends = np.cumsum(sizes)
        self.piece = np.repeat(np.arange(len(sizes)), sizes)
        self.begin, self.end = ends - sizes, ends
        self.symbol = hashes
        self.words = np.ones(len(hashes), np.int64)
        self.first = np.arange(len(hashes))
        self.past = self.first + 1
        self._runs()
        for number in range(1, rounds + 1):
            self._pairs(number)

    def _before(self, at: np.ndarray) -> np.ndarray:
        """``first`` of the symbol before; past the edge if there is none."""
        piece = self.piece[at]
        inside = (at > 0) & (self.piece[at - 1] == piece)
        return np.where(inside, self.first[at - 1], self.begin[piece] - 1)

    def _behind(self, at: np.ndarray) -> np.ndarray:
        piece = self.piece[at]
        after = np.minimum(at + 1, len(self.piece) - 1)
        inside = (at + 1 < len(self.piece)) & (self.piece[after] == piece)
        return np.where(inside, self.past[after], self.end[piece] + 1)

    def _take(self, keep: np.ndarray, symbol: np.ndarray, first: np.ndarray, past: np.ndarray) -> None:
        self.words = np.add.reduceat(self.words, keep)
        self.symbol, self.first, self.past, self.piece = symbol, first, past, self.piece[keep]

    def _runs(self) -> None:
        if not len(self.symbol):
            return
        new = np.ones(len(self.symbol), bool)
        new[1:] = (self.symbol[1:] != self.symbol[:-1]) | (self.piece[1:] != self.piece[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(new)) - 1
        length = (tail - head + 1).astype(np.uint64)
        symbol = np.where(length > 1, _mix(self.symbol[head] + length * _times(3)), self.symbol[head])
        self._take(head, symbol, self._before(head), self._behind(tail))

    def _pairs(self, number: int) -> None:
        n = len(self.symbol)
        if not n:
            return
        right = (_mix(self.symbol + _times(number)) >> np.uint64(63)).astype(bool)
        starts = np.zeros(n, bool)
        starts[:-1] = ~right[:-1] & right[1:] & (self.piece[1:] == self.piece[:-1])
        second = np.zeros(n, bool)
        second[1:] = starts[:-1]
        keep = np.flatnonzero(~second)
        paired = starts[keep]
        after = np.minimum(keep + 1, n - 1)
        name = _mix(_mix(self.symbol[keep] + _times(number)) + self.symbol[after] * _times(5))
        symbol = np.where(paired, name, self.symbol[keep])
        first = np.where(right[keep] & ~paired, self._before(keep), self.first[keep])
        past = np.where(right[keep], self.past[keep], self._behind(keep))
        self._take(keep, symbol, first, np.where(paired, self.past[after], past))

    def anchors(self, starts: np.ndarray, window: int) -> np.ndarray:
        """For windows from ``starts`` the index of their anchor, -1 where no symbol lies inside."""
        total = int(self.end[-1]) if len(self.end) else 0
        lo = np.cumsum(np.bincount(self.first + 1, minlength=total + 3))[starts]
        hi = np.cumsum(np.bincount(self.past, minlength=total + 3))[starts + window]
        short = np.uint64(255) - np.minimum(self.words, 255).astype(np.uint64)
        weight = short << np.uint64(56) | _mix(self.symbol + _times(11)) >> np.uint64(8)

        def lighter(a, b):
            return np.where(weight[b] < weight[a], b, a)

        found = np.full(len(starts), -1)
        width, best, size = hi - lo, np.arange(len(weight)), 1
        while len(best) and (some := width >= size).any():
            some &= width < 2 * size
            found[some] = lighter(best[lo[some]], best[hi[some] - size])
            if len(best) <= size:
                break
            best, size = lighter(best[:-size], best[size:]), 2 * size
        return found


def _blocks(hashes: np.ndarray, sizes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(symbol, hash, piece, first window in its piece, number of windows) of each block."""
    parse = Parse(hashes, sizes)
    spans = _Spans(hashes)
    many = np.maximum(sizes - window + 1, 0)
    piece = np.repeat(np.arange(len(sizes)), many)
    begin = (np.cumsum(sizes) - sizes)[piece]
    place = np.arange(int(many.sum())) - (np.cumsum(many) - many)[piece]
    at = begin + place
    anchor = parse.anchors(at, window)
    alone = anchor < 0
    own = np.zeros(len(at), np.uint64)
    own[alone] = spans(at[alone], at[alone] + window)
    new = np.ones(len(at), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(at)))
    span = np.where(alone[head], own[head], spans(at[head], at[head] + length + window - 1))
    symbol = np.where(alone[head], _mix(own[head] + _times(13)), parse.symbol[anchor[head]] if len(parse.symbol) else own[head])
    return symbol, span, piece[head], place[head], length


_BLOCK = "symbol long, span long, id long, content long, start int, windows int"
_BLOCK_ARROW = pa.schema([("symbol", pa.int64()), ("span", pa.int64()), ("id", pa.int64()), ("content", pa.int64()), ("start", pa.int32()), ("windows", pa.int32())])


def _parse_texts(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            pieces, held = [], 0
            for doc, content, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
                words = (text.as_py() or b"").split()
                if len(words) < window:
                    continue
                step = _PIECE - window + 1
                for at in range(0, len(words) - window + 1, step):
                    part = words[at : at + _PIECE] if len(words) > _PIECE else words
                    pieces.append((doc, content, at, known.of(part)))
                    held += len(part)
                    if held >= _PIECE:
                        yield _found(pieces, window)
                        pieces, held = [], 0
            if pieces:
                yield _found(pieces, window)

    return run


def _found(pieces: list[tuple], window: int) -> pa.RecordBatch:
    ids, contents, offsets, hashes = zip(*pieces)
    symbol, span, piece, place, length = _blocks(np.concatenate(hashes), np.array([len(h) for h in hashes]), window)
    columns = [symbol.view(np.int64), span.view(np.int64), np.array(ids)[piece], np.array(contents)[piece], np.array(offsets)[piece] + place, length]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type, safe=False) for c, f in zip(columns, _BLOCK_ARROW)], schema=_BLOCK_ARROW)


_ONE = "symbol long, span long, id long, content long, start int"


def _windows(window: int):
    """The single windows of the blocks that are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, unpack = _WordHashes(), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for doc, content, body, asked in zip(*(batch.column(i) for i in range(4))):
                spans = _Spans(known.of(unpack(body.as_py()).split()))
                symbols, starts, sizes = (asked.values.field(i).to_numpy() for i in range(3))
                at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                found = spans(at, at + window).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(symbols, sizes)), pa.array(found), pa.array([doc.as_py()] * len(at), pa.int64()), pa.array([content.as_py()] * len(at), pa.int64()), pa.array(at, pa.int32())],
                    names=[c.split()[0] for c in _ONE.split(", ")],
                )

    return run


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            total, removed, kept = [], [], []
            for body, ranges in zip(batch.column(1), batch.column(2)):
                words = unpack(body.as_py()).split()
                if ranges.is_valid:
                    starts, sizes = (ranges.values.field(i).to_numpy() for i in range(2))
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + sizes + window - 1, -1)
                    rest = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                else:
                    rest = words
                total.append(len(words))
                removed.append(len(words) - len(rest))
                kept.append(b" ".join(rest).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", "kept"]
            )

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        bodies = pa.array((pack(t.as_py() or b"") for t in batch.column(2).cast(pa.binary())), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), bodies], names=["id", "content", "body"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept) for every row.

    Removed is every word that a window of ``window`` words covers whose word sequence also starts in a
    row with a smaller id; all windows of the input count, also those of removed words. ``kept`` joins the
    other words by one space. Words are separated by ASCII white space and compared as they are. A null
    text has no words; shorter texts than a window keep all. Rows with one id are not smaller than each
    other, whatever their texts; a null id is smaller than none and none is smaller than it. An empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).select("id", F.xxhash64("text").alias("content"), "text")
    blocks = materialize(rows.filter("id IS NOT NULL").mapInArrow(_parse_texts(window), _BLOCK), "blocks")
    same = F.col("low") == F.col("high")
    shared = (
        blocks.groupBy("symbol")
        .agg(F.min("span").alias("low"), F.max("span").alias("high"), F.min("id").alias("least"), F.max("id").alias("most"))
        .filter("least < most")
        .select("symbol", same.alias("same"), "least")
    )
    # Stored, as all sides of joins here: adaptive execution splits a hot symbol only in a join of two shuffles.
    shared = materialize(shared, "shared-symbols")
    judged = materialize(blocks.join(shared, "symbol").filter("NOT same OR id > least"), "shared-blocks")
    ranges = ["id", "content", "start", "windows"]
    repeated = judged.filter("same").select(*ranges)

    mixed = judged.filter("NOT same").drop("same", "least")
    earliest = materialize(mixed.groupBy("symbol", "span").agg(F.min("id").alias("earliest")), "earliest-blocks")
    mixed = materialize(mixed.join(earliest, ["symbol", "span"]), "mixed-blocks")
    repeated = repeated.unionAll(mixed.filter("id > earliest").select(*ranges))

    texts = rows.mapInArrow(_pack, "id long, content long, body binary")
    asked = mixed.filter("id = earliest").groupBy("id", "content").agg(F.collect_list(F.struct("symbol", "start", "windows")).alias("asked"))
    # Equal rows would give their windows twice.
    once = texts.join(asked, ["id", "content"]).select("id", "content", "body", "asked")
    windows = materialize(once.mapInArrow(_windows(window), _ONE), "windows")
    earliest = windows.groupBy("symbol", "span").agg(F.min("id").alias("earliest"), F.max("id").alias("latest")).filter("earliest < latest")
    earliest = materialize(earliest, "earliest-windows")
    late = windows.join(earliest, ["symbol", "span"]).filter("id > earliest")
    repeated = repeated.unionAll(late.select("id", "content", "start", F.lit(1).alias("windows")))

    lists = repeated.groupBy("id", "content").agg(F.collect_list(F.struct("start", "windows")).alias("ranges"))
    return texts.join(lists, ["id", "content"], "left").select("id", "body", "ranges").mapInArrow(
        _remove(window), "id long, n_words long, n_removed long, kept string"
    )
