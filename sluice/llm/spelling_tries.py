"""Spelling variants by a dictionary of trie node pairs.

Every prefix of a word is a node of the trie of all words, every suffix a node of the trie of the reversed
words, and both tries are numbered. A word without its character i is the pair (node of the prefix before
it, node of the suffix after it); a whole word is such a pair at each of its cuts. Two words differ by one
replaced character where two skipped pairs meet, and by one inserted or deleted character where a skipped
pair meets a cut. Pairs are equal exactly where the strings are, so neighbours need no check. What meets
in one pair differs in one character at most, so a pair has no more words than the alphabet has letters;
it is counted and ranked in place, and no list of its neighbours is made.

The numbers come from the sorted words: the node of a prefix is (place of a word that has it, length).
Sorted words are cut into chunks of ``CHUNK``; the first words of the chunks, numbered in the same way
before, say which nodes reach beyond a chunk. So a task holds one chunk, however many words share a prefix.
"""

from __future__ import annotations

from os.path import commonprefix

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from sluice.operators.numbering import dense_number
from sluice.scratch import materialize

CHUNK = 1024  # words that one task numbers at a time
FACTOR = 5  # a form occurs at least so many times as often as its variant
_DEPTH = 32  # bits of a node for its length; the others hold the place of a word


def _shared(a: str, b: str) -> int:
    return len(commonprefix((a, b)))


def _fill(words: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
    """Nodes of the prefixes of sorted words; ``heads``: nodes of the first word and of the first of the next chunk."""
    words = words.sort_values("place")
    known = {p: (t, np.asarray(n, np.int64)) for p, t, n in zip(heads.place, heads.text, heads.nodes)}
    last_text, last = known.pop(words.place.iloc[0], ("", np.zeros(1, np.int64)))
    next_text, following = next(iter(known.values()), ("", last[:1]))
    out = []
    for place, text in zip(words.place.tolist(), words.text.tolist()):
        kept = _shared(last_text, text) + 1
        nodes = np.empty(len(text) + 1, np.int64)
        nodes[:kept] = last[:kept]
        nodes[kept:] = (place << _DEPTH) + np.arange(kept, len(text) + 1)
        beyond = _shared(text, next_text) + 1
        nodes[:beyond] = following[:beyond]
        out.append(nodes)
        last_text, last = text, nodes
    return pd.DataFrame({"rank": words["rank"], "place": words.place, "text": words.text, "nodes": out})


_NODES = "rank long, place long, text string, nodes array<long>"


def _numbered(words: DataFrame, step: int = 1) -> DataFrame:
    """(rank, place, text), places 1, 1 + ``step``, ... in the order of the texts -> with ``nodes``.

    ``nodes`` has a number per prefix, the empty one first; equal prefixes have equal numbers, others not.
    """
    size = step * CHUNK
    chunk = F.expr(f"(place - 1) div {size}L")
    if words.filter(f"place > {size}").isEmpty():
        heads = words.sparkSession.createDataFrame([], _NODES)
    else:
        heads = _numbered(materialize(words.filter((F.col("place") - 1) % size == 0), "heads"), size)
    # The first word of a chunk closes the chunk before it too.
    heads = heads.withColumn("chunk", F.explode(F.array(chunk, chunk - 1)))
    grouped = words.withColumn("chunk", chunk).groupBy("chunk").cogroup(heads.groupBy("chunk"))

    def fill(words: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
        return _fill(words, heads) if len(words) else pd.DataFrame(columns=["rank", "place", "text", "nodes"], dtype=object)

    return materialize(grouped.applyInPandas(fill, _NODES), "trie-nodes")


def node_pairs(ranked: DataFrame) -> DataFrame:
    """(rank, word, n) -> (rank, n, p, s, whole, lone): the pairs of every word.

    ``rank`` counts the distinct words from 1 in code-point order. ``whole`` pairs are cuts of the word, the
    others skip one character; ``lone`` marks those that skip the last of a run of equal characters, so that
    a shortened word is met once.
    """
    forward = ranked.select("rank", F.col("rank").alias("place"), F.col("word").alias("text"))
    backward = dense_number(ranked.select("rank", F.reverse("word").alias("text")), ["text"], "place")
    p = _numbered(forward).select("rank", F.col("nodes").alias("p"), F.col("text").alias("word"))
    s = _numbered(materialize(backward.select("rank", "place", "text"), "reversed-words")).select("rank", F.col("nodes").alias("s"))
    both = p.join(s, "rank").join(ranked.select("rank", "n"), "rank").withColumn("size", F.size("p") - 1)
    # The prefix of i characters is p[i], the suffix of j characters s[j].
    skipped = F.expr(
        "slice(transform(sequence(0, size), i -> struct(p[i] AS p, get(s, size - 1 - i) AS s, false AS whole, "
        "i = size - 1 OR substring(word, i + 1, 1) <> substring(word, i + 2, 1) AS lone)), 1, size)"
    )
    cuts = F.expr("transform(sequence(0, size), i -> struct(p[i] AS p, s[size - i] AS s, true AS whole, false AS lone))")
    found = both.select("rank", "n", F.explode(F.concat(skipped, cuts)).alias("pair"))
    return found.select("rank", "n", "pair.*")


def near_words(ranked: DataFrame) -> DataFrame:
    """(rank, word, n) -> (rank, n_near, best: struct<n, least: -rank>) for the words that have a neighbour.

    ``best`` is the neighbour of largest n, of equal ones the smallest in code-point order.
    """
    key = Window.partitionBy("p", "s")
    order, skips = F.struct("n", (-F.col("rank")).alias("least")), ~F.col("whole")
    rows = node_pairs(ranked).select("rank", "p", "s", "whole", "lone", order.alias("own"))
    rows = rows.withColumns({
        "skips": F.count_if(skips).over(key),
        "first": F.max(F.when(skips, F.col("own"))).over(key),
        "lones": F.count_if("lone").over(key),
        "lone_first": F.max(F.when(F.col("lone"), F.col("own"))).over(key),
        "there": F.max(F.when(F.col("whole"), F.col("own"))).over(key),
    }).filter("skips > 1 OR skips = 1 AND there IS NOT NULL")
    rows = rows.withColumn("second", F.max(F.when(skips & (F.col("own") != F.col("first")), F.col("own"))).over(key))
    other = F.when(F.col("own") == F.col("first"), F.col("second")).otherwise(F.col("first"))
    shorter = F.when(F.col("lone"), F.col("there"))
    met = rows.select(
        "rank",
        F.when(F.col("whole"), F.col("lones")).otherwise(F.col("skips") - 1 + shorter.isNotNull().cast("int")).alias("met"),
        F.when(F.col("whole"), F.col("lone_first")).otherwise(F.greatest(other, shorter)).alias("best"),
    )
    return met.filter("met > 0").groupBy("rank").agg(F.sum("met").alias("n_near"), F.max("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(rank, form) -> (rank, root), following forms to the last.

    n grows at least by ``FACTOR`` with each form, so chains end and are short; each round doubles the steps.
    """
    links = materialize(links.select("rank", F.col("form").alias("root")), "forms")
    while True:
        further = links.select(F.col("rank").alias("root"), F.col("root").alias("further"))
        links = materialize(links.join(further, "root", "left").select("rank", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if links.filter("moved").isEmpty():
            return links.select("rank", "root")
        links = links.select("rank", "root")


def variants(words: DataFrame, word_col: str = "word", count_col: str = "n", factor: int = FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every distinct word of ``words``.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point. The form of
    a word is its near word of largest n (ties: the smallest in code-point order) if that n is at least
    ``factor`` times its own, else null; ``root`` follows forms to the last and is the word itself without one.

    Counts of a word that stands in several rows are added up. Null words are left out, a null count is 0;
    an empty word is a word like others, near to those of one character. An empty table gives no rows. Words
    may be of any length, their cost is linear in it. Other columns are not read, whatever their names.
    """
    rows = words.select(F.col(word_col).alias("word"), F.coalesce(F.col(count_col).cast("long"), F.lit(0)).alias("n"))
    rows = rows.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    ranked = materialize(dense_number(rows, ["word"], "rank"), "ranked")
    near = near_words(ranked)
    found = ranked.join(near, "rank", "left").select(
        "rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= factor * F.col("n"), F.struct(F.col("best.n"), (-F.col("best.least")).alias("rank"))).alias("best"),
    )
    found = materialize(found.select("rank", "word", "n", "n_near", F.col("best.rank").alias("form"), F.col("best.n").alias("form_n")), "near")
    roots = _roots(found.filter("form IS NOT NULL").select("rank", "form"))
    names = ranked.select(F.col("rank").alias("named"), F.col("word").alias("name"))
    variant = found.filter("form IS NOT NULL").join(roots, "rank").withColumnRenamed("form", "named").join(names, "named").drop("named").withColumnRenamed("name", "form")
    variant = variant.withColumnRenamed("root", "named").join(names, "named").select("word", "n", "n_near", "form", "form_n", F.col("name").alias("root"))
    plain = found.filter("form IS NULL").select("word", "n", "n_near", F.lit(None).cast("string").alias("form"), "form_n", F.col("word").alias("root"))
    return variant.unionAll(plain)
