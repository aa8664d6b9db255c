import math
import random
import zlib

import pytest
import zstandard

from sluice.llm import queries as Q, zstd_quality as Z

DOCS = "doc_id long, text string, lang string, id string, score string, label string, quality string"


def texts(draw, n, bad):
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8)))
    out = []
    for _ in range(n):
        words = [word() for _ in range(draw.randint(20, 200))]
        out.append(" ".join(w + draw.choice(["$$$", "%%%"]) for w in words) if bad else " ".join(words) + ".")
    return out


@pytest.fixture(scope="module")
def model():
    draw = random.Random(1)
    return Z.train({0: texts(draw, 80, True), 1: texts(draw, 80, False)}, {0: 20.0, 1: 60.0})


def by_hand(model, text):
    """The score of a text from the sizes that the library gives."""
    data = (text or "").encode()
    if not data:
        return model.prior
    sizes = []
    for d in model.dictionaries:
        c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
        sizes.append(sum(len(c.compress(data[i : i + 4096])) for i in range(0, len(data), 4096)))
    left = math.log((sizes[0] + sizes[1]) / 2 / (len(data) + 16))
    found = [(sizes[0] - sizes[1]) / (sizes[0] + sizes[1]), left, left**2]
    z = model.weights[-1] + sum(w * (f - m) / s for w, f, m, s in zip(model.weights, found, model.means, model.scales))
    return 1 / (1 + math.exp(-z))


def test_scores_equal_brute_force(spark, model):
    draw = random.Random(2)
    some = [None, "", "x", "é" * 9000, "a b " * 60_000, *texts(draw, 15, True), *texts(draw, 15, False)]
    rows = [(None if k % 7 == 3 else k // 2, t, "l", "i", "s", "l", "q") for k, t in enumerate(some)]
    got = Z.score(spark.createDataFrame(rows, DOCS).repartition(3), model).collect()
    wanted = sorted((str(r[0]), round(by_hand(model, r[1]), 9)) for r in rows)
    assert sorted((str(r.id), round(r.score, 9)) for r in got) == wanted
    assert Z.score(spark.createDataFrame([], DOCS), model).collect() == []


def test_labels_are_told_apart(model):
    draw = random.Random(3)
    score = Z._Scorer(model)
    assert min(score([t.encode() for t in texts(draw, 40, False)])) > 0.5 > max(score([t.encode() for t in texts(draw, 40, True)]))


def test_sample_is_bounded_and_without_copies(spark):
    rows = [(k % 50, f"text {k % 300} " + "w " * (k % 7), "l", "i", "s", "l", "q") for k in range(2000)]
    rows += [(1, "hot", "l", "i", "s", "l", "q")] * 3000 + [(2, "y" * 30_000, "l", "i", "s", "l", "q"), (None, "none", "l", "i", "s", "l", "q")]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)] + [(3, 1, 0), (None, 1, 0), (5, None, 0), (7, 9, 0)], "doc_id long, quality int, toxic int")
    found, sizes = Z.sample(docs, labels, per_label=20)
    assert sizes == {0: 30.0, 1: 30.0} and {k: len(v) for k, v in found.items()} == {0: 20, 1: 20}
    assert all(len(set(v)) == len(v) and "y" * 30_000 not in v for v in found.values())
    assert Z.sample(docs, labels, per_label=20)[0] == found


@pytest.mark.parametrize("samples", [{}, {1: ["one good text"]}, {0: ["bad"], 1: ["good"]}, {0: [""], 1: ["good"]}])
def test_few_labels(spark, samples):
    model = Z.train(samples, {k: 1.0 for k in samples})
    scores = Z._Scorer(model)([b"good", b"", None])
    assert all(0 <= s <= 1 for s in scores) and scores[1] == scores[2] == model.prior


def test_query(spark, sf_dir, documents):
    got = {r.doc_id: r for r in Q.op12_zstd_quality(spark, sf_dir).collect()}
    assert sorted(got) == sorted(r.doc_id for r in documents.collect())
    right = wrong = 0
    for label in spark.read.parquet(f"{sf_dir}/labels.parquet").collect():
        row = got.get(label.doc_id)
        if row is None:
            continue
        assert row.held_out == (zlib.crc32(str(label.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
        if row.held_out:
            right, wrong = right + (row.predicted == label.quality), wrong + (row.predicted != label.quality)
    assert right >= 9 * wrong and right > 5
