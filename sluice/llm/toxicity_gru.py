"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its own vector, if the training sample knows it, and as the end states of a
bidirectional network over its characters. A second bidirectional network runs over windows of words;
attention weighs its states into one vector and a logistic unit scores it. Windows overlap by a
third and cover the whole text; the score of a text is that of its most toxic window. Training sees labels of
whole texts only: the log-sum-exp over the windows of a text stands for the text.

The network is fitted by the driver on a bounded sample of labelled texts and sent to the tasks. A task
computes what a distinct word contributes once and remembers it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

WINDOW, STRIDE = 24, 16  # words of a window, and between the starts of two
PER_LABEL = {1: 1500, 0: 2500}  # expected labelled rows of the sample; those with longer texts are passed over
LONGEST = 400  # words of a training text
VOCABULARY = 20_000  # words with a vector of their own
HIDDEN, CHARS_HIDDEN, CHAR_SIZE, WORD_SIZE, ATTENTION = 8, 8, 8, 8, 8
STEPS, BATCH, RATE = 400, {1: 8, 0: 16}, 0.01  # steps, texts by label in a step
KNOWN = 3  # training texts from which a word gets a vector of its own
DROPPED = 0.3  # share of the words whose vector a training step leaves out, so that characters count too
LETTERS = 128  # characters told apart
PIECE = 20  # characters of a word; longer runs are cut
THRESHOLD = 0.7
_CACHE_WORDS = 200_000  # words whose gates a task remembers at a time
_ROWS = 4096  # windows scored at a time

_words = re.compile(rf"\w{{1,{PIECE}}}").findall


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def letters_of(words: list[str]) -> np.ndarray:
    """(longest, U) numbers of the characters: a to z have their own, others share the rest."""
    codes = np.array(words, dtype=f"<U{max(map(len, words))}").view(np.uint32).reshape(len(words), -1).T
    return np.where((codes >= 97) & (codes <= 122), codes - 96, 27 + codes % (LETTERS - 27)).astype(np.int64)


class _Numbered(dict):
    """Gives each new word the next number."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def run_gru(gates: np.ndarray, u: np.ndarray, mask: np.ndarray | None, backward: bool, keep: list | None = None) -> np.ndarray:
    """States (T, B, H) of a gated unit over input gates (T, B, 3H); where the mask is 0 a state stays."""
    steps, rows, width = gates.shape
    h = width // 3
    state, out = np.zeros((rows, h), gates.dtype), np.empty((steps, rows, h), gates.dtype)
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        g, a = gates[t], state @ u
        rz = _sigmoid(g[:, : 2 * h] + a[:, : 2 * h])
        r, z = rz[:, :h], rz[:, h:]
        n = np.tanh(g[:, 2 * h :] + r * a[:, 2 * h :])
        new = n + z * (state - n)
        if mask is not None:
            new = np.where(mask[t][:, None], new, state)
        if keep is not None:
            keep.append((t, state, r, z, n, a[:, 2 * h :]))
        state = out[t] = new
    return out


def run_full(tables: list[np.ndarray], numbers: np.ndarray, u: np.ndarray, backward: bool) -> np.ndarray:
    """States as of ``run_gru`` for full windows (T, B) of words whose gates are in three tables (U, H).

    Each gate has arrays of its own without gaps, which the machine runs through several times faster.
    """
    (steps, rows), h = numbers.shape, len(u)
    parts = [np.ascontiguousarray(u[:, k * h : (k + 1) * h]) for k in range(3)]
    state, out = np.zeros((rows, h), u.dtype), np.empty((steps, rows, h), u.dtype)
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        r, z, n = (table[numbers[t]] for table in tables)
        for gate, part in ((r, parts[0]), (z, parts[1])):
            gate += state @ part
            gate *= 0.5
            np.tanh(gate, out=gate)
            gate += 1
            gate *= 0.5
        r *= state @ parts[2]
        n += r
        np.tanh(n, out=n)
        state = state - n
        state *= z
        state += n
        out[t] = state
    return out


def back_gru(kept: list, u: np.ndarray, mask: np.ndarray | None, slopes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input gates and of ``u`` from those of all states."""
    steps, rows, h = slopes.shape
    d_gates, d_u, d_state = np.zeros((steps, rows, 3 * h), slopes.dtype), np.zeros_like(u), np.zeros((rows, h), slopes.dtype)
    for t, state, r, z, n, a in reversed(kept):
        d = slopes[t] + d_state
        d_new = d if mask is None else d * mask[t][:, None]
        d_n = d_new * (1 - z) * (1 - n * n)
        d_z = d_new * (state - n) * z * (1 - z)
        d_r = d_n * a * r * (1 - r)
        d_gates[t] = np.concatenate([d_r, d_z, d_n], axis=1)
        d_a = np.concatenate([d_r, d_z, d_n * r], axis=1)
        d_u += state.T @ d_a
        d_state = d_a @ u.T + d_new * z + (0 if mask is None else d - d_new)
    return d_gates, d_u


@dataclass
class Network:
    """Parameters, the numbers of known words, and the share of toxic rows in training."""

    vocabulary: dict[str, int]
    prior: float
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, vocabulary: dict[str, int], prior: float, seed: int = 11) -> Network:
        draw = np.random.default_rng(seed)
        normal = lambda *shape: (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        zeros = lambda *shape: np.zeros(shape, np.float32)
        size = WORD_SIZE + 2 * CHARS_HIDDEN
        w = {"chars": normal(LETTERS, CHAR_SIZE) * 8, "words": normal(len(vocabulary) + 1, WORD_SIZE) * 0}
        for side in "fb":
            w |= {f"cx{side}": normal(CHAR_SIZE, 3 * CHARS_HIDDEN), f"cb{side}": zeros(3 * CHARS_HIDDEN), f"cu{side}": normal(CHARS_HIDDEN, 3 * CHARS_HIDDEN)}
            w |= {f"wx{side}": normal(size, 3 * HIDDEN), f"wb{side}": zeros(3 * HIDDEN), f"wu{side}": normal(HIDDEN, 3 * HIDDEN)}
        w |= {"aw": normal(2 * HIDDEN, ATTENTION), "ab": zeros(ATTENTION), "av": normal(ATTENTION), "ow": normal(2 * HIDDEN), "ob": zeros(1) - 3}
        return cls(vocabulary, prior, w)

    # -- forward; ``keep`` collects what the way back needs

    def word_inputs(self, words: list[str], keep: dict | None = None, dropped: np.ndarray | None = None) -> np.ndarray:
        """(U, size) input of each word: its vector and the end states over its characters."""
        w, letters, ends = self.weights, letters_of(words), []
        mask = np.arange(len(letters))[:, None] < np.array(list(map(len, words)))[None, :]
        for side in "fb":
            gates = (w["chars"] @ w[f"cx{side}"] + w[f"cb{side}"])[letters]
            kept = None if keep is None else keep.setdefault(f"c{side}", [])
            states = run_gru(gates, w[f"cu{side}"], mask, side == "b", kept)
            ends.append(states[-1] if side == "f" else states[0])
        known = np.array([self.vocabulary.get(x, -1) for x in words]) + 1
        if dropped is not None:
            known[dropped] = 0
        if keep is not None:
            keep |= {"letters": letters, "cmask": mask, "known": known}
        return np.concatenate([w["words"][known] * (known > 0)[:, None], *ends], axis=1)

    def gates_of(self, words: list[str]) -> np.ndarray:
        """(U, 6H) gates of words in order of length: words of one length need no mask."""
        w, sizes, ends = self.weights, np.array(list(map(len, words))), []
        for side in "fb":
            gates = w["chars"] @ w[f"cx{side}"] + w[f"cb{side}"]
            tables = [np.ascontiguousarray(gates[:, k * CHARS_HIDDEN : (k + 1) * CHARS_HIDDEN]) for k in range(3)]
            parts = []
            for size in np.unique(sizes):
                a, b = np.searchsorted(sizes, [size, size + 1])
                states = run_full(tables, letters_of(words[a:b]), w[f"cu{side}"], side == "b")
                parts.append(states[-1] if side == "f" else states[0])
            ends.append(np.concatenate(parts))
        known = np.array([self.vocabulary.get(x, -1) for x in words]) + 1
        return self.gates(np.concatenate([w["words"][known] * (known > 0)[:, None], *ends], axis=1))

    def gates(self, inputs: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.concatenate([inputs @ w[f"wx{s}"] + w[f"wb{s}"] for s in "fb"], axis=1)

    def window_scores(self, gates: np.ndarray, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        """Logit of each window from its words' gates (T, B, 6H)."""
        w, h = self.weights, 3 * HIDDEN
        sides = []
        for k, side in enumerate("fb"):
            kept = None if keep is None else keep.setdefault(f"w{side}", [])
            sides.append(run_gru(gates[:, :, k * h : (k + 1) * h], w[f"wu{side}"], mask, side == "b", kept))
        return self._pooled(np.concatenate(sides, axis=2), mask, keep)

    def full_scores(self, tables: list[np.ndarray], numbers: np.ndarray) -> np.ndarray:
        """Logits of full windows (T, B) of words whose gates are in six tables (U, H)."""
        sides = [run_full(tables[3 * k : 3 * k + 3], numbers, self.weights[f"wu{side}"], side == "b") for k, side in enumerate("fb")]
        return self._pooled(np.concatenate(sides, axis=2), None, None)

    def _pooled(self, states: np.ndarray, mask: np.ndarray | None, keep: dict | None) -> np.ndarray:
        w = self.weights
        shown = np.tanh(states @ w["aw"] + w["ab"])
        force = shown @ w["av"]
        if mask is not None:
            force = np.where(mask, force, -1e9)
        force = np.exp(force - force.max(axis=0))
        share = force / force.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", share, states)
        if keep is not None:
            keep |= {"states": states, "shown": shown, "share": share, "pooled": pooled}
        return pooled @ w["ow"] + w["ob"][0]

    # -- training

    def slopes(self, words: list[str], windows: np.ndarray, mask: np.ndarray, text: np.ndarray, label: np.ndarray, dropped: np.ndarray | None = None) -> tuple[dict, float]:
        """Gradients and loss of some texts: ``windows`` (T, B) numbers of words, ``text`` of each window."""
        w, keep, h = self.weights, {}, 3 * HIDDEN
        inputs = self.word_inputs(words, keep, dropped)
        logits = self.window_scores(self.gates(inputs)[windows], mask, keep)
        top = np.full(len(label), -np.inf)
        np.maximum.at(top, text, logits)
        parts = np.exp(logits - top[text])
        whole = np.bincount(text, parts, len(label))
        p = _sigmoid(np.log(whole) + top)
        loss = -np.mean(np.log(np.where(label == 1, p, 1 - p) + 1e-9))
        d_logit = (((p - label) / len(label))[text] * parts / whole[text]).astype(np.float32)

        d = {"ow": keep["pooled"].T @ d_logit, "ob": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * w["ow"]
        states, share = keep["states"], keep["share"]
        d_states = share[:, :, None] * d_pooled
        d_share = np.einsum("tbh,bh->tb", states, d_pooled)
        d_force = share * (d_share - (share * d_share).sum(axis=0))
        d["av"] = np.einsum("tb,tba->a", d_force, keep["shown"])
        d_shown = d_force[:, :, None] * w["av"] * (1 - keep["shown"] ** 2)
        d["aw"], d["ab"] = np.einsum("tbh,tba->ha", states, d_shown), d_shown.sum(axis=(0, 1))
        d_states = d_states + d_shown @ w["aw"].T
        d_inputs = np.zeros_like(inputs)
        for k, side in enumerate("fb"):
            d_gates, d[f"wu{side}"] = back_gru(keep[f"w{side}"], w[f"wu{side}"], mask, d_states[:, :, k * HIDDEN : (k + 1) * HIDDEN])
            by_word = np.zeros((len(words), h), np.float32)
            np.add.at(by_word, windows[mask], d_gates[mask])
            d[f"wx{side}"], d[f"wb{side}"] = inputs.T @ by_word, by_word.sum(axis=0)
            d_inputs += by_word @ w[f"wx{side}"].T
        known = keep["known"]
        d["words"] = np.zeros_like(w["words"])
        np.add.at(d["words"], known, d_inputs[:, :WORD_SIZE] * (known > 0)[:, None])
        d["chars"] = np.zeros_like(w["chars"])
        for k, side in enumerate("fb"):
            ends = np.zeros((len(keep["letters"]), len(words), CHARS_HIDDEN), np.float32)
            begin = WORD_SIZE + k * CHARS_HIDDEN
            ends[-1 if side == "f" else 0] = d_inputs[:, begin : begin + CHARS_HIDDEN]
            d_gates, d[f"cu{side}"] = back_gru(keep[f"c{side}"], w[f"cu{side}"], keep["cmask"], ends)
            by_letter = np.zeros((LETTERS, 3 * CHARS_HIDDEN), np.float32)
            np.add.at(by_letter, keep["letters"][keep["cmask"]], d_gates[keep["cmask"]])
            d[f"cx{side}"], d[f"cb{side}"] = w["chars"].T @ by_letter, by_letter.sum(axis=0)
            d["chars"] += by_letter @ w[f"cx{side}"].T
        return d, float(loss)


def window_starts(words: int) -> np.ndarray:
    """First words of the overlapping windows that cover a text of ``words`` words."""
    if words <= WINDOW:
        return np.zeros(min(words, 1), np.int64)
    return np.append(np.arange(0, words - WINDOW, STRIDE), words - WINDOW)


def train(samples: list[tuple[str, int]], *, steps: int = STEPS, seed: int = 11) -> Network:
    """Fit a network on (text, label) pairs; without both labels it has a prior only.

    Each step takes as many texts of a label as ``BATCH`` says, whatever their share.
    """
    labels = [y for _, y in samples]
    network = Network({}, sum(labels) / len(labels) if labels else 0.0)
    cut = [(words_of(t), y) for t, y in samples]
    by_label = [[w for w, y in cut if w and y == label] for label in (0, 1)]
    if not all(by_label):
        return network
    counts = Counter(x for texts in by_label for words in texts for x in set(words))
    vocabulary = {x: k for k, (x, n) in enumerate(counts.most_common(VOCABULARY)) if n >= KNOWN}
    network = Network.fresh(vocabulary, network.prior, seed)
    draw = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.weights.items()}
    queues: list[list[int]] = [[], []]
    for step in range(1, steps + 1):
        index: dict[str, int] = {}
        rows, sizes, text, label = [], [], [], []
        for y, texts in enumerate(by_label):
            if len(queues[y]) < BATCH[y]:
                queues[y] += draw.permutation(len(texts)).tolist() * -(-BATCH[y] // len(texts))
            for i in (queues[y].pop(0) for _ in range(BATCH[y])):
                numbers = np.array([index.setdefault(x, len(index)) for x in texts[i]])
                for start in window_starts(len(numbers)):
                    piece = numbers[start : start + WINDOW]
                    rows.append(np.pad(piece, (0, WINDOW - len(piece))))
                    sizes.append(len(piece))
                    text.append(len(label))
                label.append(y)
        mask = np.arange(WINDOW)[:, None] < np.array(sizes)[None, :]
        slopes, _ = network.slopes(list(index), np.array(rows).T, mask, np.array(text), np.array(label), draw.random(len(index)) < DROPPED)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for name, d in slopes.items():
            m, v = moments[name]
            d = np.clip(d, -1, 1)
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            network.weights[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> list[tuple[str, int]]:
    """About ``PER_LABEL`` labelled texts, without those of more than ``LONGEST`` words.

    Which rows are taken depends on a hash of the id. The sample of labels has a bounded size and is
    broadcast; texts of other rows do not leave the scan.
    """
    given = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)").distinct()
    sizes = {r.label: r.n for r in given.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
    share = F.lit(0.0)
    for label, most in PER_LABEL.items():
        share = F.when(F.col("label") == label, F.lit(most / max(1, sizes.get(label, 1)))).otherwise(share)
    chosen = F.broadcast(given.filter(place < share))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull() & (F.size(F.split("text", r"\s+", LONGEST + 2)) <= LONGEST)
    )
    found = rows.join(chosen, "id").select("id", "text", "label").collect()
    return [(r.text, r.label) for r in sorted(found)]


class _Scorer:
    """Scores texts; remembers the gates of words."""

    def __init__(self, network: Network) -> None:
        self.network = network
        self.index = _Numbered()
        self.tables = [np.zeros((0, HIDDEN), np.float32)] * 6

    def _numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.index) > _CACHE_WORDS:
            self.__init__(self.network)
        index, before = self.index, len(self.index)
        out = [np.fromiter(map(index.__getitem__, words), np.int64, len(words)) for words in texts]
        new = sorted(islice(index, before, None), key=len)
        if new:
            gates = np.zeros((len(new), 6 * HIDDEN), np.float32)
            for at in range(0, len(new), 20_000):
                part = new[at : at + 20_000]
                gates[[index[w] - before for w in part]] = self.network.gates_of(part)
            self.tables = [np.concatenate([table, gates[:, k * HIDDEN : (k + 1) * HIDDEN]]) for k, table in enumerate(self.tables)]
        return out

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        scores = np.full(len(texts), self.network.prior)
        if not self.network.weights:
            return scores
        numbers = self._numbers([words_of(t) for t in texts])
        sizes = np.array([len(x) for x in numbers])
        offset = np.cumsum(sizes) - sizes
        flat = np.concatenate(numbers)
        whole, short = sizes >= WINDOW, (sizes > 0) & (sizes < WINDOW)
        best = np.full(len(texts), -np.inf)
        for chosen in (np.flatnonzero(whole), np.flatnonzero(short)):
            starts = [window_starts(n) for n in sizes[chosen]]
            if not starts:
                continue
            text = np.repeat(chosen, [len(s) for s in starts])
            begin = offset[text] + np.concatenate(starts)
            for at in range(0, len(begin), _ROWS):
                places = begin[None, at : at + _ROWS] + np.arange(WINDOW)[:, None]
                if whole[chosen[0]]:
                    logits = self.network.full_scores(self.tables, flat[places])
                else:
                    mask = np.arange(WINDOW)[:, None] < sizes[text[at : at + _ROWS]]
                    numbers_of = flat[np.minimum(places, len(flat) - 1)]
                    logits = self.network.window_scores(np.concatenate([t[numbers_of] for t in self.tables], axis=2), mask)
                np.maximum.at(best, text[at : at + _ROWS], logits)
        some = sizes > 0
        scores[some] = _sigmoid(best[some].astype(np.float64))
        return scores


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row, from its whole text alone.

    A text without words, null included, has the share of toxic rows in training as score, as has any text
    under a network that was not given both labels. Repeated rows and null ids give a row each; an empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)  # bounded by VOCABULARY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            for part in _parts(batch.column(1)):
                texts = batch.column(1).slice(*part).to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(*part), pa.array(scorer(texts), pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, score double")


def with_score(docs: DataFrame, network: Network, text_col: str = "text", name: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` and ``name``, the score as in ``score``, without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            for part in _parts(batch.column(at)):
                rows = batch.slice(*part)
                scores = pa.array(scorer(rows.column(at).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([*rows.columns, scores], names=[*rows.schema.names, name])
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def _parts(texts: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """(offset, length) of runs of texts of about ``most`` bytes."""
    begin, held = 0, 0
    for k, text in enumerate(texts.cast(pa.binary())):
        held += len(text.as_buffer()) if text.is_valid else 0
        if held >= most:
            yield begin, k + 1 - begin
            begin, held = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts) - begin


def fit(docs: DataFrame, labels: DataFrame, **columns) -> Network:
    """``train`` on the ``sample`` of labelled texts."""
    return train(sample(docs, labels, **columns))
