"""Benchmark decontamination by latent semantic retrieval.

Items are cut into segments of at most ``SEGMENT`` words; texts into passages of two half blocks each.
The space is that of the words of the items. Corpus-wide passage counts give the weights; one pass over
all passages sums what a randomised decomposition (Nystroem, with the segments as extra rows) needs, by
chunks of terms, so that what comes to the driver is bounded by the items. Then every passage is compared
with every segment in the latent space, by their projections. What is near enough is verified on the words:
longest common subsequence of segment and text in a window little longer than the segment, and that of its
answer, the last sentence. How well the space finds a segment is measured before, on copies that just count,
planted into passages drawn from the corpus; the few segments whose copies it misses, and those of fewer than
eight words, are looked up by their rarest words besides.

The texts are read once; what the passes share is the list of item words of each text with their places,
which is all that a common subsequence can consist of. Items go through in blocks of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.packing import expand, numbers, squeeze
from sluice.scratch import materialize

SEGMENT = 64  # words of a segment at most
HALF = 32  # words of half a passage
RANK = 64  # latent dimensions
FREQUENT = 0.1  # terms in a larger share of the passages do not count for retrieval
NEAR, SHARE = 0.35, 0.3  # least cosine, and share of the segment's weight, from which a passage is verified
PLANTED, MARGIN = 24, 1.15  # planted copies of a segment, all of which the space has to find, and by how much
COVERED, PARTLY, ANSWERED = 0.75, 0.6, 0.8  # covered; or partly covered and the answer covered
ITEMS = 20_000  # items of a block
_SLACK = 1.25  # length of the window against that of the segment
_TOKENS = 20_000  # words of texts handled at a time: what is gathered for them stays in the cache
_TERMS = 512  # terms of a chunk of sums
_MORE = 0.15  # share of a segment's words looked up beyond those that can be missing
_HITS = 2_000_000  # looked-up words handled at a time
_PART = 1_000  # segments handled at a time on the driver
_DOTS = 4_000_000  # passages times segments compared at a time

_words = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


@dataclass
class Segments:
    """The segments of a block of items, in words and numbers of the block's vocabulary."""

    items: list
    terms: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: dict[str, int]


def segments(items: list[tuple]) -> Segments:
    """Cut (item id, text) into segments; the answer of a segment is the last sentence of its item."""
    out = Segments([], [], [], {})
    number = out.vocabulary
    for item, text in items:
        words = words_of(text)
        sentences = [s for s in map(words_of, re.split(r"[.!?\n]+", text or "")) if s]
        coded = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        answer = np.array([number[w] for w in sentences[-1] if w in number] if sentences else [], np.int64)
        pieces = max(1, -(-len(words) // SEGMENT))
        for part in np.array_split(coded, pieces) if len(words) else []:
            out.items.append(item)
            out.terms.append(part)
            out.answers.append(answer if pieces == 1 else part[:0])
    return out


_TOKEN_ARROW = pa.schema([("id", pa.int64()), ("words", pa.int64()), ("payload", pa.binary())])


def _tokens(shared):
    """The item words of each text and the gaps between their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.vocabulary.get
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                coded = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
                places = np.flatnonzero(coded >= 0)
                if len(places):
                    rows.append((doc, len(words), squeeze(np.diff(places, prepend=0), coded[places])))
                if len(rows) >= 2_000:
                    yield _rows(rows, _TOKEN_ARROW)
                    rows = []
            if rows:
                yield _rows(rows, _TOKEN_ARROW)
        pa.default_memory_pool().release_unused()

    return run


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


@dataclass
class _Passages:
    """Some texts side by side: their terms, and the passages by half blocks."""

    docs: list
    owner: np.ndarray  # text of each token
    place: np.ndarray  # word number in its text
    term: np.ndarray
    half: np.ndarray  # half block of each token, counted over all texts
    first: np.ndarray  # first half block of each text
    passages: np.ndarray  # half block that each passage begins with
    text: np.ndarray  # text of each passage


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[_Passages]:
    rows, held = [], 0
    for batch in batches:
        for doc, words, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            gaps, terms = map(numbers, expand(payload.as_py()))
            rows.append((doc, words, np.cumsum(gaps, dtype=np.int64), terms.astype(np.int64)))
            held += len(terms)
            if held >= _TOKENS:
                yield _side_by_side(rows)
                rows, held = [], 0
    if rows:
        yield _side_by_side(rows)


def _side_by_side(rows: list[tuple]) -> _Passages:
    docs, words, places, terms = zip(*rows)
    halves = np.maximum(1, -(-np.array(words) // HALF))
    first = np.cumsum(halves) - halves
    owner = np.repeat(np.arange(len(rows)), [len(t) for t in terms])
    place, term = np.concatenate(places), np.concatenate(terms)
    many = np.maximum(1, halves - 1)
    text = np.repeat(np.arange(len(rows)), many)
    passages = first[text] + np.arange(len(text)) - (np.cumsum(many) - many)[text]
    return _Passages(list(docs), owner, place, term, first[owner] + place // HALF, first, passages, text)


def _of_passages(p: _Passages, values: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Sum over each passage of a row of ``values`` per kept token."""
    total = int(p.passages[-1]) + 2
    sums = np.zeros((total + 1, values.shape[1]), values.dtype)
    half = p.half[kept]
    if len(half):
        begin = np.flatnonzero(np.diff(half, prepend=-1))
        sums[half[begin]] = np.add.reduceat(values, begin, axis=0)
    last = np.append(p.first[1:], total)[p.text]
    two = p.passages + 1 < last
    return sums[p.passages] + np.where(two[:, None], sums[p.passages + 1], 0)


def _frequencies(size: int):
    """Passages that hold each term; one vector per task. The last entry counts the passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 1, np.int64)
        for p in _gathered(batches):
            # A half block belongs to the passage it begins and to the one before.
            later = p.half > p.first[p.owner]
            pairs = np.unique(np.concatenate([p.half * size + p.term, (p.half[later] - 1) * size + p.term[later]]))
            of, term = pairs // size, pairs % size
            begins = np.zeros(int(p.passages[-1]) + 3, bool)
            begins[p.passages] = True
            counts[:size] += np.bincount(term[begins[of]], minlength=size)
            counts[size] += len(p.passages)
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["term", "n"])

    return run


def _sketch(shared):
    """A'A times the random matrix, summed over the task's passages, by chunks of terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, random = shared.value
        weighted = (weight[:, None] * random).astype(np.float32)
        total = np.zeros(random.shape)
        for p in _gathered(batches):
            kept = np.flatnonzero(weight[p.term] > 0)
            if not len(kept):
                continue
            norm = np.sqrt(_of_passages(p, (weight[p.term[kept]] ** 2)[:, None], kept))
            image = _of_passages(p, weighted[p.term[kept]], kept) / np.maximum(norm, 1e-9) ** 2
            # Back along the tokens: each lies in the passage its half block begins and the one before.
            by_half = np.zeros((int(p.passages[-1]) + 3, image.shape[1]), np.float32)
            by_half[p.passages] += image
            last = np.append(p.first[1:], int(p.passages[-1]) + 2)[p.text]
            two = p.passages + 1 < last
            by_half[p.passages[two] + 1] += image[two]
            order = np.argsort(p.term[kept], kind="stable")
            term = p.term[kept][order]
            begin = np.flatnonzero(np.diff(term, prepend=-1))
            sums = np.add.reduceat(by_half[p.half[kept][order]], begin, axis=0)
            total[term[begin]] += weight[term[begin], None] * sums
        for at in range(0, len(total), _TERMS):
            part = total[at : at + _TERMS]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([part.tobytes()], pa.binary())], names=["chunk", "sums"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk: the sum of its rows, which lie in one task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(part.as_py(), np.float64)
            sums[chunk] = sums[chunk] + part if chunk in sums else part
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(sums), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["chunk", "sums"])


def _bags(found: Segments, rows: np.ndarray) -> np.ndarray:
    """Sum of ``rows`` (a vector a term) over the words of each segment."""
    out = np.zeros((len(found.terms), rows.shape[1]), rows.dtype)
    for at in range(0, len(out), _PART):
        part = found.terms[at : at + _PART]
        out[at : at + _PART] = np.add.reduceat(rows[np.concatenate(part)], np.cumsum([0, *map(len, part[:-1])]), axis=0)
    return out


def _norms(found: Segments, weight: np.ndarray) -> np.ndarray:
    counted = (np.unique(t, return_counts=True) for t in found.terms)
    return np.maximum(np.sqrt([float((((n * weight[t]) ** 2).sum())) for t, n in counted]), 1e-9)


def _back(found: Segments, weight: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The transpose: each segment's row, by the weight of the term, summed over the places of every term."""
    out = np.zeros((size, rows.shape[1]))
    for at in range(0, len(found.terms), _PART):
        part = found.terms[at : at + _PART]
        terms = np.concatenate(part)
        order = np.argsort(terms, kind="stable")
        owner = np.repeat(np.arange(at, at + len(part)), [len(t) for t in part])[order]
        begin = np.flatnonzero(np.diff(terms[order], prepend=-1))
        out[terms[order][begin]] += weight[terms[order][begin], None] * np.add.reduceat(rows[owner], begin, axis=0)
    return out


def thresholds(found: Segments, weight: np.ndarray, space: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cosine and share from which a passage is verified for each segment, and which segments the space finds.

    These are the least that any of ``PLANTED`` copies has that just count, with a margin. Below ``NEAR`` and
    ``SHARE`` too much else would be near, so the space does not find a segment with such a copy. A copy has ``PARTLY`` of the words, spread over the window that such a copy may take; it stands anywhere
    against the half blocks, and the rest of its passage are terms drawn as they occur in the corpus.
    """
    weighted = (weight[:, None] * space).astype(np.float32)
    latent = _bags(found, weighted)
    within = np.maximum(np.linalg.norm(latent, axis=1), 1e-9)
    drawn = np.where(weight > 0, counts[: len(weight)], 0)
    usual = drawn.sum() / max(1.0, counts[len(weight)])
    draw = np.random.default_rng(11)
    least = np.ones((2, len(found.terms)))
    noise = draw.choice(len(weight), 1 << 16, p=drawn / drawn.sum()) if drawn.sum() else np.zeros(1, np.int64)
    for _ in range(PLANTED):
        for at in range(0, len(within), _PART):
            planted = []
            for segment in found.terms[at : at + _PART]:
                size = len(segment)
                kept = np.sort(draw.choice(size, int(np.ceil(size * PARTLY)), replace=False))
                # Words of the copy that the better of the two passages around its begin holds.
                place, offset = kept * reach_of(size) // size, draw.integers(HALF)
                inside = max((place < 2 * HALF - offset, (place >= HALF - offset) & (place < 3 * HALF - offset)), key=np.count_nonzero)
                others = draw.poisson(usual * max(0.0, 1 - np.count_nonzero(inside) / (2 * HALF))) if drawn.sum() else 0
                planted.append(np.concatenate([segment[kept[inside]], noise[draw.integers(0, len(noise), others)]]))
            vectors = _bags(Segments([], planted, [], {}), weighted)
            part = slice(at, at + _PART)
            dots = (vectors * latent[part]).sum(axis=1) / MARGIN
            cosine = dots / np.maximum(np.linalg.norm(vectors, axis=1) * within[part], 1e-9)
            least[:, part] = np.minimum(least[:, part], [cosine, dots / within[part] ** 2])
    good = (least[0] >= NEAR) & (least[1] >= SHARE) & [len(t) >= 8 for t in found.terms]
    return np.maximum(least[0], NEAR).astype(np.float32), np.maximum(least[1], SHARE).astype(np.float32), good


def decompose(image: np.ndarray, random: np.ndarray) -> np.ndarray:
    """Right singular vectors of A from A'A R and R (columns, by falling singular value)."""
    core = random.T @ image
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > values[-1] * 1e-9
    root = image @ vectors[:, good] / np.sqrt(values[good])
    return np.linalg.svd(root, full_matrices=False)[0]


def common_words(pattern: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of the pattern."""
    places: dict[int, int] = {}
    for i, t in enumerate(pattern.tolist()):
        places[t] = places.get(t, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    free = full
    for t in text.tolist():
        hit = free & places.get(t, 0)
        free = (free + hit | free - hit) & full
    return len(pattern) - free.bit_count()


def reach_of(size: int) -> int:
    """Words of the window for a segment of ``size`` words."""
    return int(np.ceil(size * _SLACK)) if size >= 8 else size


def verify(segment: np.ndarray, answer: np.ndarray, place: np.ndarray, term: np.ndarray, low: int, high: int) -> tuple[float, float, int, int]:
    """Best (coverage, answer coverage, first, past) of windows that touch the words [low, high) of a text.

    Windows that share too few words with the segment, in whatever order, to make it count are not compared.
    """
    size = len(segment)
    least = PARTLY if size >= 8 else 1.0
    # A short segment has to stand there word for word.
    reach = reach_of(size)
    step = max(1, size // 4) if size >= 8 else 1
    start = max(0, low - size) // step * step  # the same windows, whatever part of the text is looked at
    a, b = np.searchsorted(place, [start, high + reach])
    own, needed = np.unique(segment, return_counts=True)
    number = np.minimum(np.searchsorted(own, term[a:b]), len(own) - 1)
    inside = own[number] == term[a:b]
    places, terms, number = place[a:b][inside], term[a:b][inside], number[inside]
    best = (0.0, 0.0, low, low)
    for begin in range(start, high, step):
        a, b = np.searchsorted(places, [begin, begin + reach])
        if (b - a) / size < least or (b - a) / size <= best[0]:
            continue
        shared = np.minimum(np.bincount(number[a:b], minlength=len(own)), needed).sum() / size
        if shared < least or shared <= best[0]:
            continue
        share = common_words(segment, terms[a:b]) / size
        if share > best[0]:
            told = common_words(answer, terms[a:b]) / len(answer) if len(answer) else 0.0
            best = (share, told, int(places[a]), int(places[b - 1]) + 1)
    return best


def contaminated(size: int, share: float, answer: float) -> bool:
    """Whether a segment of ``size`` words counts as found."""
    return share >= 1 if size < 8 else share >= COVERED or (share >= PARTLY and answer >= ANSWERED)


_FOUND_ARROW = pa.schema([
    ("id", pa.int64()), ("segment", pa.int32()), ("cosine", pa.float64()), ("coverage", pa.float64()), ("answer", pa.float64()),
    ("first_word", pa.int64()), ("past_word", pa.int64()),
])
_FOUND = "id long, segment int, cosine double, coverage double, answer double, first_word long, past_word long"


@dataclass
class Signatures:
    """The rarest words of the segments, as lists of segments by term."""

    begin: np.ndarray  # first entry of each term; one more at the end
    segment: np.ndarray
    needed: np.ndarray  # words of its signature that a text with the segment holds in one window
    reach: np.ndarray


def signatures(found: Segments, counts: np.ndarray, without: np.ndarray) -> Signatures:
    """Of n words, at most n - m are missing where m have to be found: of any n - m + k words k are there.

    The segments marked in ``without`` have no signature and are not looked up.
    """
    terms, owners, needed = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    for s, segment in enumerate(found.terms):
        if without[s]:
            needed.append(1)
            continue
        size = len(segment)
        least = int(np.ceil(size * PARTLY - 1e-9)) if size >= 8 else size
        many = min(size, size - least + max(1, int(np.ceil(size * _MORE)))) if size >= 8 else size
        own = np.unique(segment[np.argsort(counts[segment], kind="stable")[:many]])
        terms.append(own)
        owners.append(np.full(len(own), s))
        needed.append(many - (size - least))
    term, owner = np.concatenate(terms), np.concatenate(owners)
    order = np.argsort(term, kind="stable")
    begin = np.searchsorted(term[order], np.arange(len(found.vocabulary) + 1))
    kind = np.uint16 if len(found.terms) < 1 << 16 else np.int64  # short numbers are sorted by digits
    reach = np.array([reach_of(len(t)) for t in found.terms])
    return Signatures(begin, owner[order].astype(kind), np.array(needed), reach)


def looked_up(p: _Passages, known: Signatures) -> Iterator[tuple[int, int, int, int]]:
    """(text, segment, low, high): words of a text between which windows can hold the segment."""
    sizes = known.begin[p.term + 1] - known.begin[p.term]
    some = np.flatnonzero(sizes)
    if not len(some):
        return
    line = p.owner[some] * (1 << 40) + p.place[some]
    sizes, terms = sizes[some], p.term[some]
    total = np.cumsum(sizes)
    longest = int(known.reach.max())
    at = 0
    while at < len(some):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _HITS, side="right")))
        part = slice(int(np.searchsorted(line, line[at] - longest)), end)  # with the windows that begin before
        many = sizes[part]
        token = np.repeat(np.arange(part.start, end), many)
        entry = np.arange(len(token)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(known.begin[terms[part]], many)
        segment = known.segment[entry]
        order = np.argsort(segment, kind="stable")
        segment, place = segment[order].astype(np.int64), line[token[order]]
        last = np.arange(len(segment)) + known.needed[segment] - 1
        inside = np.flatnonzero(last < len(segment))
        last = last[inside]
        near = (segment[last] == segment[inside]) & (place[last] - place[inside] < known.reach[segment[inside]])
        segment, low, high = segment[inside[near]], place[inside[near]], place[last[near]]
        if len(segment):
            # Windows that overlap go together.
            new = np.ones(len(segment), bool)
            new[1:] = (segment[1:] != segment[:-1]) | (low[1:] - high[:-1] > known.reach[segment[1:]])
            edge = np.append(np.flatnonzero(new), len(segment))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                s, first = int(segment[a]), int(low[a])
                text, extra = first >> 40, int(known.reach[segment[a]])
                yield text, s, max(0, (first & (1 << 40) - 1) - extra), int(high[b - 1] & (1 << 40) - 1) + 1
        at = end


def _search(shared):
    """Segments that are near a passage in the space, or whose rare words stand together; verified on the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, weight, space, latent, known, cosines, shares = shared.value
        weighted = (weight[:, None] * space).astype(np.float32)
        within = np.maximum(np.linalg.norm(latent, axis=1), 1e-9)  # norms in the space
        step = max(1, _DOTS // len(latent))
        for p in _gathered(batches):
            edges = np.searchsorted(p.owner, np.arange(len(p.docs) + 1))
            out: dict[tuple, tuple] = {}

            def cosine(text: int, s: int, first: int, past: int) -> float:
                """The largest of the passages that these words of the text touch."""
                a, b = edges[text], edges[text + 1]
                final = max(0, int(np.searchsorted(p.text, text, side="right") - np.searchsorted(p.text, text)) - 1)
                best = 0.0
                for half in range(min(final, max(0, first // HALF - 1)), min(final, past // HALF) + 1):
                    c, d = a + np.searchsorted(p.place[a:b], [half * HALF, (half + 2) * HALF])
                    vector = weighted[p.term[c:d]].sum(axis=0)
                    best = max(best, float(vector @ latent[s]) / (max(float(np.linalg.norm(vector)), 1e-9) * float(within[s])))
                return min(1.0, best)

            def check(text: int, s: int, low: int, high: int) -> None:
                a, b = edges[text], edges[text + 1]
                segment = found.terms[s]
                share, told, first, past = verify(segment, found.answers[s], p.place[a:b], p.term[a:b], low, high)
                if contaminated(len(segment), share, told):
                    row = (p.docs[text], s, cosine(text, s, first, past), share, told, first, past)
                    out[text, s] = max(out.get((text, s), row), row, key=lambda r: (r[3], r[2], -r[5]))

            kept = np.flatnonzero(weight[p.term] > 0)
            vectors = _of_passages(p, weighted[p.term[kept]], kept) if len(kept) else np.zeros((0, 1), np.float32)
            for at in range(0, len(vectors), step):
                part = vectors[at : at + step]
                dots = part @ latent.T
                near = dots >= np.maximum(np.maximum(np.linalg.norm(part, axis=1), 1e-9)[:, None] * (cosines * within), shares * within**2)
                for passage, s in zip(*np.nonzero(near)):
                    text, s = int(p.text[passage + at]), int(s)
                    low = int(p.passages[passage + at] - p.first[text]) * HALF
                    check(text, s, low, low + 2 * HALF)
            for candidate in looked_up(p, known):
                check(*candidate)
            if out:
                yield _rows(list(out.values()), _FOUND_ARROW)

    return run


def _one_block(docs: DataFrame, found: Segments, rank: int) -> DataFrame:
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast  # all of it is bounded by the items of the block
    size = len(found.vocabulary)
    tokens = materialize(docs.mapInArrow(_tokens(share(found)), "id long, words long, payload binary"), "item-words")
    counted = tokens.mapInArrow(_frequencies(size), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size + 1)
    for r in counted:
        counts[r.term] = r.n
    passages = max(1.0, counts[size])
    idf = np.log((passages + len(found.terms) + 1) / (counts[:size] + 1))
    rare = counts[:size] <= FREQUENT * passages
    for terms in found.terms:  # a segment of frequent words keeps them all
        if rare[np.unique(terms)].sum() < min(3, len(np.unique(terms))):
            rare[terms] = True
    weight = np.where(rare, np.maximum(idf, 1e-3), 0.0)

    random = np.random.default_rng(7).standard_normal((size, min(rank, size)))
    image = np.zeros(random.shape)
    sums = tokens.mapInArrow(_sketch(share((weight, random))), "chunk long, sums binary").repartition("chunk").mapInArrow(_summed, "chunk long, sums binary")
    for r in sums.collect():
        image[r.chunk : r.chunk + _TERMS] = np.frombuffer(r.sums).reshape(-1, random.shape[1])
    norms = _norms(found, weight)
    # The segments weigh as much as the corpus, so that the space holds them.
    unit = _bags(found, weight[:, None] * random) / norms[:, None] ** 2
    image += max(1.0, passages / len(unit)) * _back(found, weight, unit, size)
    space = decompose(image, random)
    latent = _bags(found, weight[:, None] * space).astype(np.float32)
    cosines, shares, good = thresholds(found, weight, space, counts)
    state = share((found, weight, space.astype(np.float32), latent, signatures(found, counts, good), cosines, shares))
    items = spark.createDataFrame(list(enumerate(found.items)), "segment int, item long")
    return tokens.mapInArrow(_search(state), _FOUND).join(F.broadcast(items), "segment")  # a row per segment


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", *, rank: int = RANK, items_per_block: int = ITEMS,
) -> DataFrame:
    """(id, item, cosine, coverage, answer, first_word, past_word): the items that a text holds.

    One row per text and item with its best segment; clean texts have none. Null and empty texts and items
    hold nothing; equal rows give equal rows; ids and items may be null; no documents or no items give no
    rows. An item of fewer than eight words has to stand in the text word for word.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).dropna(subset=["text"])
    blocks = -(-items.count() // items_per_block)
    found = []
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        cut = segments(sorted((tuple(r) for r in part), key=str))
        if cut.terms:
            found.append(_one_block(rows, cut, rank))
    if not found:
        return docs.sparkSession.createDataFrame([], "id long, item long, cosine double, coverage double, answer double, first_word long, past_word long")
    together = found[0]
    for more in found[1:]:
        together = together.unionAll(more)
    # A text has few rows here; texts of one id are told apart by the places only if these differ.
    best = F.max_by(F.struct("cosine", "coverage", "answer", "first_word", "past_word"), F.struct("coverage", "cosine", -F.col("first_word")))
    return together.groupBy("id", "item").agg(best.alias("best")).select("id", "item", "best.*")
