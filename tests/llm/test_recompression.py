import random
from collections import defaultdict

import numpy as np
import pytest

from check_oracle import compare, connect
from sluice.llm import recompression as R
from sluice.llm.queries import ORACLE, QUERIES


def by_hand(rows, window=50):
    least = defaultdict(lambda: float("inf"))
    cut = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in cut:
        for k in range(len(words) - window + 1):
            if i is not None:
                key = tuple(words[k : k + window])
                least[key] = min(least[key], i)
    out = []
    for i, words in cut:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and least[tuple(words[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), b" ".join(kept).decode()))
    return sorted(out, key=str)


def test_query_equals_sql(spark, sf_dir):
    assert compare(QUERIES["op10_recompression"](spark, sf_dir), connect(sf_dir), ORACLE["op10_recompression"]) == ""


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(docs_of, seed):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range([3, 40, 2000, 5][seed])]
    text = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    passages = [text(draw.randint(30, 140)) for _ in range(6)] + [["run"] * 160, ["a", "b"] * 60]
    rows = []
    for i in range(60):
        words = []
        for _ in range(draw.randint(0, 4)):
            words += text(draw.randint(0, 60))
            passage = draw.choice(passages)
            begin = draw.randint(0, 20)
            words += passage[begin : draw.randint(begin, len(passage))] if draw.random() < 0.5 else passage
        rows.append((i * 3 % 61, " ".join(words)))
    rows += [rows[5], (rows[7][0], rows[8][1]), (None, rows[9][1]), (None, rows[9][1])]
    got = sorted((tuple(r) for r in R.remove_repeats(docs_of(rows)).collect()), key=str)
    assert got == by_hand(rows)


def test_edge_rows(docs_of):
    long = " ".join(f"x{k % 701}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, "a  b\n c"), (4, "w " * 49), (5, "w " * 50), (6, "w " * 50), (7, "w\t" * 300), (8, long), (9, long), (9, long)]
    got = sorted((tuple(r) for r in R.remove_repeats(docs_of(rows)).collect()), key=str)
    assert got == by_hand(rows)
    assert R.remove_repeats(docs_of(rows).filter("false")).count() == 0


def test_a_window_has_one_anchor_wherever_it_stands():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 30, 4000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole = R.Parse(words, np.array([4000]))
    anchors = whole.anchors(np.arange(3951), 50)
    assert (anchors >= 0).mean() > 0.95
    for at in range(0, 3951, 37):
        cut = R.Parse(words[at : at + 50], np.array([50]))
        found = int(cut.anchors(np.array([0]), 50)[0])
        assert (found >= 0) == (anchors[at] >= 0)
        if found >= 0:
            assert cut.symbol[found] == whole.symbol[anchors[at]]
            assert cut.first[found] + at == whole.first[anchors[at]]


def test_texts_longer_than_a_piece():
    draw = np.random.default_rng(2)
    hashes = draw.integers(0, 2**63, 900).astype(np.uint64)
    whole = R._blocks(hashes, np.array([900]), 50)
    assert whole[4].sum() == 851 and len(whole[0]) < 200
