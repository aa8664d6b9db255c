"""Quality of texts by how well dictionaries of good and of bad text compress them.

Two zstandard dictionaries are trained on labelled texts, one per label. A text is compressed with either,
in pieces, so that a long text is judged by the dictionaries all along and not by its own repetitions.
The normalised difference of the two sizes, and the share of the text that is left after compression (text
that repeats itself leaves next to nothing), are calibrated by a logistic regression on labelled texts that
the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

PER_LABEL = 600  # most texts of a label that the fit takes; one half makes the dictionary, the other calibrates
LONGEST = 20_000  # most bytes of a text that the fit takes
DICTIONARY = 112_640  # most bytes of a dictionary
PIECE = 4_096  # bytes that are compressed at a time
LEVEL = 3
THRESHOLD = 0.3
_CANDIDATES = 4  # labelled ids per wanted text, since some have no text, a long one or a copy
_PLAIN = 16  # bytes added to a length before its share is taken, the size of an empty frame


@dataclass(frozen=True)
class Model:
    """Dictionaries by label (None: that label was not given) and the calibration."""

    dictionaries: tuple[bytes | None, bytes | None]
    weights: tuple[float, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    prior: float


def pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


def dictionary(texts: list[bytes]) -> bytes | None:
    """Trained on the pieces of ``texts``; too few of them make a dictionary of their bytes as they are."""
    samples = [p for t in texts for p in pieces(t)]
    if not samples:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY:]


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    # Bytes without the mark of a trained dictionary are taken as they are.
    table = zstandard.ZstdCompressionDict(data)
    table.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=table, write_content_size=False, write_dict_id=False, write_checksum=False)


class _Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.ready = all(model.dictionaries) and bool(model.weights)
        self.by_label = [_compressor(d) for d in model.dictionaries] if all(model.dictionaries) else []

    def features(self, text: bytes) -> tuple[float, ...]:
        """Normalised difference of the sizes, and log of what is left of the text, with its square."""
        parts = pieces(text)
        bad, good = (sum(len(c.compress(p)) for p in parts) for c in self.by_label)
        left = np.log((bad + good) / 2 / (len(text) + _PLAIN))
        return (bad - good) / (bad + good), left, left * left

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        scores = np.full(len(texts), self.model.prior)
        some = [k for k, t in enumerate(texts) if t] if self.ready else []
        if some:
            found = np.array([self.features(texts[k]) for k in some])
            scores[some] = _logistic(found, self.model.weights, self.model.means, self.model.scales)
        return scores


def _logistic(found, weights, means, scales) -> np.ndarray:
    z = (np.asarray(found) - means) / scales @ np.asarray(weights[:-1]) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _calibrate(found: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> tuple:
    """Weights of a ridge logistic regression by Newton steps, ``rows`` being the weight of each text."""
    means, scales = found.mean(axis=0), found.std(axis=0) + 1e-9
    x = np.column_stack([(found - means) / scales, np.ones(len(found))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (rows * (labels - p)) - 0.01 * w
        w = w + np.linalg.solve(x.T @ (x * (rows * p * (1 - p))[:, None]) + 0.01 * np.eye(len(w)), slope)
    return tuple(w.tolist()), tuple(means.tolist()), tuple(scales.tolist())


def train(samples: dict[int, list[str]], shares: dict[int, float]) -> Model:
    """``samples``: texts by label, 0 bad and 1 good; ``shares``: how frequent the labels are among all rows."""
    prior = shares.get(1, 0.0) / (sum(shares.values()) or 1) if shares else 0.5
    texts = {k: [t.encode() for t in samples.get(k, []) if t] for k in (0, 1)}
    # Without a second text the same one has to calibrate.
    rest = {k: t[1::2] or t for k, t in texts.items()}
    model = Model((dictionary(texts[0][::2]), dictionary(texts[1][::2])), (), (), (), prior)
    scorer = _Scorer(model)
    if not scorer.by_label:
        return model
    found = np.array([scorer.features(t) for k in (0, 1) for t in rest[k]])
    labels = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    rows = np.where(labels == 1, prior / labels.mean(), (1 - prior) / (1 - labels.mean()))
    return Model(model.dictionaries, *_calibrate(found, labels, rows), prior)


def sample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    per_label: int = PER_LABEL,
) -> tuple[dict[int, list[str]], dict[int, float]]:
    """At most ``per_label`` distinct texts of each label, of up to ``LONGEST`` bytes, and the number of ids of each.

    Drawn by hashes, so that a run can be repeated. Only so many ids as are needed are sent to the rows; copies of
    a text count once and are dropped before anything goes to the driver, so no hot id or text makes the sample
    larger or one-sided.
    """
    given = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)").distinct()
    sizes = {r.label: r.n for r in given.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
    wanted = F.lit(False)
    for label, n in sizes.items():
        wanted = wanted | ((F.col("label") == label) & (place < _CANDIDATES * per_label / n))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter(F.octet_length("text").between(1, LONGEST))
    found = rows.join(F.broadcast(given.filter(wanted)), "id").select("label", "text").distinct()
    texts = {k: found.filter(F.col("label") == k).orderBy(F.xxhash64("text"), "text").limit(per_label).collect() for k in sizes}
    return {k: [r.text for r in v] for k, v in texts.items()}, {k: float(n) for k, n in sizes.items()}


def fit(docs: DataFrame, labels: DataFrame, **columns) -> Model:
    """``train`` on the ``sample`` of labelled texts; labels without a text, and other values than 0 and 1, are left out."""
    return train(*sample(docs, labels, **columns))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row, from its whole text alone: 0 to 1, higher where label 1 is likelier.

    A null or empty text has the share of good rows in training as score, and so has any text under a model
    that was not given texts of both labels. A text of any length is read in pieces. Repeated rows and null
    ids give a row each, an empty table no rows; other columns are not read, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of at most DICTIONARY bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            texts = (t.as_buffer().to_pybytes() if t.is_valid else None for t in batch.column(1).cast(pa.large_binary()))
            scores = [scorer([t])[0] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, score double")
