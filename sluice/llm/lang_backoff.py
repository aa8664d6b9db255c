"""Language identification, words first: known words score by their log frequency in each language,
unseen words by the longest character n-grams of theirs that are known.

The model is fitted on a bounded sample of labelled texts, so its tables have a bounded size and can
be sent to every task. Prediction reads each text once and needs no shuffle.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

DOCS_PER_LANG = 1000  # expected texts of the sample per language
WORDS_PER_LANG = 40_000  # most frequent words kept per language
LONGEST = 5  # characters of the longest n-gram
UNKNOWN = "und"
_ADD = 0.1  # added to every count
_STEADY = 20  # words from which the score does not grow sharper
_CACHE_WORDS = 500_000  # words whose scores a task remembers at a time

_words = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return _words(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """The character n-grams of a word, its ends marked."""
    marked = f"\x02{word}\x03"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Log frequencies per language of known words, and of n-grams by their length."""

    langs: list[str]
    words: dict[str, np.ndarray] = field(default_factory=dict)
    grams: dict[int, dict[str, np.ndarray]] = field(default_factory=dict)

    def score(self, word: str) -> np.ndarray:
        """Per language: the log frequency of a known word, else the mean of its longest known n-grams."""
        known = self.words.get(word)
        if known is not None:
            return known
        for n in range(LONGEST, 0, -1):
            table = self.grams.get(n, {})
            found = [table[g] for g in grams_of(word, n) if g in table]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(len(self.langs))


def _log_frequencies(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    total = sum(counts.values()) + _ADD * len(counts)
    return {key: np.log((n + _ADD) / total) for key, n in counts.items()}


def fit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *,
    docs_per_lang: int = DOCS_PER_LANG, words_per_lang: int = WORDS_PER_LANG,
) -> Model:
    """Fit on about ``docs_per_lang`` distinct texts of each language, chosen by a hash of the text.

    Copies of a text count once, however many there are, so that no hot text makes the sample larger or decides
    on a language. Rows with a null text or language are passed over. Without any row left the model knows no
    language. Texts may be of any length; other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    # A sketch tells how many distinct texts there are; it only sets the share that is drawn.
    distinct = F.greatest(F.approx_count_distinct(F.xxhash64("text")), F.lit(1))
    sizes = rows.groupBy("lang").agg(F.least(F.lit(1.0), docs_per_lang / distinct).alias("share"))
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1_000_000
    sample = rows.join(F.broadcast(sizes), "lang").filter(place < F.col("share"))  # a row per language
    sample = sample.select("lang", "text").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = defaultdict(int)
            for lang, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
                for word in words_of(text):
                    found[lang, word] += 1
            if found:
                langs, words = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(words), pa.array(found.values(), pa.int64())], names=["lang", "word", "n"])

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    kept = counted.withColumn("place", place).filter(F.col("place") <= words_per_lang).select("lang", "word", "n").collect()
    langs = sorted({r.lang for r in kept})
    at = {lang: i for i, lang in enumerate(langs)}
    words: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(langs)))
    for r in sorted(kept):
        words[r.word][at[r.lang]] += r.n
    model = Model(langs, _log_frequencies(words))
    for n in range(1, LONGEST + 1):
        grams: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(langs)))
        for word, counts in words.items():
            for gram in grams_of(word, n):
                grams[gram] += counts
        model.grams[n] = _log_frequencies(grams)
    return model


class _Scorer:
    """Scores of texts, with the scores of their words remembered."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.model.langs)))
        self.letter = np.zeros(1024, bool)

    def _add(self, word: str) -> int:
        n = len(self.index)
        if n == len(self.rows):
            self.rows, self.letter = (np.concatenate([x, np.zeros_like(x)]) for x in (self.rows, self.letter))
        self.index[word] = n
        self.rows[n] = self.model.score(word)
        self.letter[n] = any(map(str.isalpha, word))
        return n

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text or "")
        if len(self.index) > _CACHE_WORDS:
            self._reset()
        get, add = self.index.get, self._add
        ids = np.fromiter((add(w) if (i := get(w)) is None else i for w in words), np.int64, len(words))
        ids = ids[self.letter[ids]]
        if not len(ids) or not self.model.langs:
            return UNKNOWN, 0.0
        total = self.rows[ids].sum(axis=0) * (min(_STEADY, len(ids)) / len(ids))
        weight = np.exp(total - total.max())
        best = int(np.argmax(weight))
        return self.model.langs[best], float(weight[best] / weight.sum())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score) for every row, from its whole text alone.

    ``score`` is the share of the best language, 0 to 1. A text that is null or has no letter, and any
    text under a model without languages, is ``und`` with score 0; languages that tie go by name. Repeated
    rows and null ids give a row each; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the parameters of fit()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            found = [scorer(t.as_py()) for t in batch.column(1)]
            langs, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, lang string, score double")
