import random

import numpy as np
import pytest

from sluice.llm import lsa_decontam as L
from sluice.llm.queries import QUERIES


def common_by_hand(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def pairs_by_hand(docs, items):
    """Texts against items over all windows, without retrieval."""
    cut, out = L.segments(items), set()
    for doc, text in docs:
        coded = np.array([cut.vocabulary.get(w, -1) for w in L.words_of(text)])
        place = np.flatnonzero(coded >= 0)
        for item, terms, answer in zip(cut.items, cut.terms, cut.answers):
            if len(coded) and np.isin(coded, terms).sum() >= 0.6 * len(terms):
                share, told, _, _ = L.verify(terms, answer, place, coded[place], 0, len(coded))
                if L.contaminated(len(terms), share, told):
                    out.add((doc, item))
    return out


def test_query_equals_brute_force(spark, sf_dir, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in QUERIES["op5_lsa_decontamination"](spark, sf_dir).collect()}
    assert got == pairs_by_hand(docs, items) and got


def test_common_words():
    draw = random.Random(2)
    for _ in range(200):
        a, b = ([draw.randrange(6) for _ in range(draw.randint(0, 40))] for _ in range(2))
        assert L.common_words(np.array(a, int), np.array(b, int)) == common_by_hand(a, b)


def test_decomposition_finds_the_leading_space():
    draw = np.random.default_rng(0)
    a = draw.standard_normal((500, 6)) @ np.diag([9, 7, 5, 3, 2, 1]) @ draw.standard_normal((6, 60))
    random_ = draw.standard_normal((60, 12))
    space = L.decompose(a.T @ (a @ random_), random_)[:, :6]
    exact = np.linalg.svd(a, full_matrices=False)[2][:6].T
    assert np.linalg.svd(space.T @ exact)[1].min() > 0.999


@pytest.fixture(scope="module")
def world():
    draw = random.Random(9)
    common = [f"c{k}" for k in range(30)]
    text = lambda n: [draw.choice(common) if draw.random() < 0.5 else f"r{draw.randrange(4000)}" for _ in range(n)]
    items = [(k, " ".join(text(draw.randint(20, 60)))) for k in range(40)] + [(50, " ".join(text(200)))]
    docs = [(k, " ".join(text(draw.randint(0, 400)))) for k in range(120)]
    return draw, text, items, docs


def test_exact_shifted_and_paraphrased(spark, docs_of, world):
    draw, text, items, docs = world
    planted, wanted = [], set()
    for k, (item, body) in enumerate(items[:40]):
        words = body.split()
        if k % 3 == 1:  # every seventh word another one
            words = [w if i % 7 else "other" for i, w in enumerate(words)]
        elif k % 3 == 2:  # words put in
            words = [x for i, w in enumerate(words) for x in ([w, "more"] if i % 9 == 4 else [w])]
        planted.append((1000 + k, " ".join(text(draw.randint(0, 150)) + words + text(draw.randint(0, 150)))))
        wanted.add((1000 + k, item))
    long = items[-1][1].split()
    planted.append((2000, " ".join(text(90) + long[50:] + text(20))))
    wanted.add((2000, 50))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = L.find_leaks(docs_of(docs + planted), benchmark).collect()
    assert {(r.id, r.item) for r in got} == wanted
    assert all(r.coverage >= 0.75 and 0 <= r.first_word < r.past_word for r in got)
    blocks = L.find_leaks(docs_of(docs + planted), benchmark, items_per_block=15).collect()
    assert {(r.id, r.item) for r in blocks} == wanted


def test_edge_rows(spark, docs_of):
    schema = "item_id long, text string, id long"
    benchmark = spark.createDataFrame([(1, "one two three four", 0), (2, None, 0), (3, "", 0), (None, "alpha beta gamma delta epsilon zeta eta theta iota", 0), (1, "one two three four", 0)], schema)
    rows = [
        (1, None), (2, ""), (3, "so one TWO, three four it is"), (4, "one two or three four"), (None, "alpha beta gamma delta epsilon zeta eta theta iota"),
        (5, "x " * 30_000 + "one two three four"), (6, "alpha beta gamma delta x epsilon zeta eta theta iota"), (6, "alpha beta gamma delta x epsilon zeta eta theta iota"),
    ]
    got = {(r.id, r.item) for r in L.find_leaks(docs_of(rows), benchmark).collect()}
    assert got == {(3, 1), (None, None), (5, 1), (6, None)}
    assert L.find_leaks(docs_of(rows).filter("false"), benchmark).count() == 0
    assert L.find_leaks(docs_of(rows), benchmark.filter("false")).count() == 0


@pytest.mark.parametrize("many", [200, 2000])
def test_recall_equals_brute_force_beyond_the_rank(spark, docs_of, many):
    draw = random.Random(many)
    text = lambda n: [f"w{min(draw.randrange(3000), draw.randrange(3000))}" for _ in range(n)]
    items = [(k, " ".join(text(draw.randint(15, 59)))) for k in range(many)]
    docs = []
    for k in range(150):  # whole items, and items with a fifth of the words changed, in texts of item words
        words = items[draw.randrange(many)][1].split()
        if k % 3 == 0:
            words = [w if draw.random() < 0.8 else "other" for w in words]
        docs.append((k, " ".join(text(draw.randint(20, 200)) + words + text(draw.randint(20, 200)))))
    got = {(r.id, r.item) for r in L.find_leaks(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == pairs_by_hand(docs, items) and len(got) > 110


@pytest.mark.parametrize("many", [200, 2000])
def test_recall_of_the_space_alone(spark, docs_of, monkeypatch, many):
    draw = random.Random(many + 1)
    text = lambda n: [f"w{min(draw.randrange(3000), draw.randrange(3000))}" for _ in range(n)]
    items = [(k, " ".join(text(draw.randint(15, 59)))) for k in range(many)]
    docs = []
    for k in range(150):
        words = items[draw.randrange(many)][1].split()
        if k % 3 == 0:
            words = [w if draw.random() < 0.8 else "other" for w in words]
        docs.append((k, " ".join(text(draw.randint(20, 200)) + words + text(draw.randint(20, 200)))))
    wanted = pairs_by_hand(docs, items)
    # No segment is looked up by its words.
    real = L.thresholds
    monkeypatch.setattr(L, "thresholds", lambda found, *more: (*real(found, *more)[:2], np.ones(len(found.terms), bool)))
    got = {(r.id, r.item) for r in L.find_leaks(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got <= wanted and len(got) >= 0.9 * len(wanted)
