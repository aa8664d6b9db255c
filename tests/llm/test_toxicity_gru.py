import random

import numpy as np
import pytest

from sluice.llm import toxicity_gru as T
from sluice.llm.queries import QUERIES


def texts(n, seed):
    """Toxic texts hold a word of a list, or one that begins like it."""
    draw, out = random.Random(seed), []
    for k in range(n):
        words = ["".join(draw.choice(["ba", "ne", "li", "so", "tu", "me"]) for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(3, 90))]
        label = int(draw.random() < 0.4)
        if label:
            for _ in range(draw.randint(1, 3)):
                words.insert(draw.randrange(len(words)), draw.choice(["vexor", "gratch", "xqu" + draw.choice(["a", "in", "ol", "est"])]))
        out.append((" ".join(words), label))
    return out


@pytest.fixture(scope="module")
def network():
    return T.train(texts(300, 1), steps=150)


def by_hand(network, text):
    words = T.words_of(text)
    if not words or not network.weights:
        return network.prior
    scores = []
    for a in T.window_starts(len(words)):
        gates = network.gates(network.word_inputs(words[a : a + T.WINDOW]))[:, None, :]
        scores.append(float(T._sigmoid(network.window_scores(gates, None)[0])))
    return max(scores)


def test_held_out_accuracy(network):
    held = texts(200, 2)
    scores = np.concatenate([T._Scorer(network)([t for t, _ in held])])
    label = np.array([y for _, y in held])
    assert np.mean((scores >= 0.5) == label) > 0.95
    assert all(by_hand(network, f"ba ne xqu{end} so") > 0.5 for end in ("emu", "art"))  # by its characters


def test_slopes_are_those_of_the_loss(network):
    net = T.Network.fresh({"a": 0, "bad": 1}, 0.5, 3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    draw = np.random.default_rng(1)
    net.weights["words"] += draw.standard_normal(net.weights["words"].shape)
    words = ["a", "bad", "word", "x", "longerword"]
    windows, sizes = draw.integers(0, 5, (T.WINDOW, 6)), np.array([24, 24, 5, 24, 10, 24])
    args = words, windows, np.arange(T.WINDOW)[:, None] < sizes, np.array([0, 0, 1, 2, 2, 2]), np.array([1, 0, 1])
    slopes, _ = net.slopes(*args)
    for name, d in slopes.items():
        w = net.weights[name]
        for at in [tuple(draw.integers(0, n) for n in w.shape) for _ in range(3)] if name not in ("words", "chars") else [(1, 2)]:
            before, losses = w[at], []
            for step in (1e-5, -1e-5):
                w[at] = before + step
                losses.append(net.slopes(*args)[1])
            w[at] = before
            assert d[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-3, abs=1e-7)


@pytest.mark.parametrize("n", [0, 1, 23, 24, 25, 40, 41, 100, 1001])
def test_windows_overlap_and_cover(n):
    starts = T.window_starts(n)
    covered = {k for s in starts for k in range(s, min(n, s + T.WINDOW))}
    assert covered == set(range(n)) and all(b - a <= T.STRIDE < T.WINDOW for a, b in zip(starts, starts[1:]))


def test_edge_rows(docs_of, network):
    rows = [(1, None), (2, ""), (3, "?! ..."), (4, "vexor"), (4, "vexor"), (None, "ba ne"), (5, "ba " * 40_000 + "gratch"), (6, "x" * 5000), (7, "ba ne li " * 8), (8, "日本 ñandú " * 20)]
    got = sorted(((r.id, r.score) for r in T.score(docs_of(rows), network).collect()), key=str)
    wanted = sorted(((i, by_hand(network, t)) for i, t in rows), key=str)
    assert [g[0] for g in got] == [w[0] for w in wanted]
    assert sorted(g[1] for g in got) == pytest.approx(sorted(w[1] for w in wanted), abs=1e-5)
    assert T.score(docs_of(rows).filter("false"), network).count() == 0
    assert T._words("x" * 50) == ["x" * 20, "x" * 20, "x" * 10]


def test_one_label_gives_the_prior(docs_of):
    assert T._Scorer(T.train([("a b", 1), ("c", 1)]))(["x", None]).tolist() == [1, 1]
    assert T._Scorer(T.train([]))(["x"]).tolist() == [0]


def test_query(spark, sf_dir, documents, monkeypatch):
    monkeypatch.setattr(T, "STEPS", 20)
    rows = QUERIES["op3_toxicity_gru"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents.collect())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert 0.2 < sum(r.held_out for r in rows) / len(rows) < 0.5


def test_sample_has_labelled_short_texts_only(spark, docs_of):
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 1), (2, 0, 0), (3, 0, None), (None, 0, 1), (5, 0, 1), (9, 0, 0)], schema)
    rows = [(1, "bad"), (2, "good one"), (3, "unlabelled"), (None, "no id"), (5, "w " * 500), (7, "other")]
    assert T.sample(docs_of(rows), labels) == [("bad", 1), ("good one", 0)]
