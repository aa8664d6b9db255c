import math

import numpy as np
import pytest

from sluice.llm import lang_backoff as L
from sluice.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op1_language_id"](spark, sf_dir).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert 0.1 < len(held) / len(rows) < 0.3
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the cat and the dog", "en"), ("the house", "en"), ("le chat et le chien", "fr"), (None, "fr"), ("lost", None), ("der hund und die katze", "de")]
    return L.fit(spark.createDataFrame(rows, "text string, lang string"))


def by_hand(model, text):
    total, n = np.zeros(len(model.langs)), 0
    for word in L.words_of(text or ""):
        if not any(c.isalpha() for c in word):
            continue
        n += 1
        if word in model.words:
            total += model.words[word]
            continue
        for size in (5, 4, 3, 2, 1):
            marked = f"\x02{word}\x03"
            found = [model.grams[size][g] for i in range(len(marked) - size + 1) if (g := marked[i : i + size]) in model.grams[size]]
            if found:
                total += sum(found) / len(found)
                break
    if not n:
        return "und", 0.0
    weight = [math.exp(x - max(total * min(20, n) / n)) for x in total * min(20, n) / n]
    return model.langs[int(np.argmax(weight))], max(weight) / sum(weight)


def test_model(model):
    assert model.langs == ["de", "en", "fr"]
    assert model.words["the"][1] == pytest.approx(math.log(3.1 / (7 + 0.1 * len(model.words))))
    assert model.score("then")[1] > model.score("then")[2]  # by its n-grams
    assert model.score("中").tolist() == [model.grams[1]["\x02"].tolist(), model.score("中").tolist()][1]


def test_edge_rows(spark, docs_of, model):
    rows = [(1, None), (2, ""), (3, "12 ?! ²"), (4, "The DOG, the"), (5, "chiens"), (5, "chiens"), (None, "katzen hund"), (6, "le " * 60_000), (7, "中文"), (8, "a²b")]
    got = sorted(((r.id, r.lang, r.score) for r in L.predict(docs_of(rows), model).collect()), key=str)
    wanted = sorted(((i, *by_hand(model, t)) for i, t in rows), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in wanted]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in wanted])
    assert L.predict(docs_of(rows).filter("false"), model).count() == 0


def test_nothing_to_learn_from(spark, docs_of):
    model = L.fit(spark.createDataFrame([(None, "en"), ("x", None)], "text string, lang string"))
    assert [tuple(r) for r in L.predict(docs_of([(1, "some text")]), model).collect()] == [(1, "und", 0.0)]


def test_a_hot_text_counts_once(spark):
    schema = "text string, lang string"
    texts = [(f"wort{k} und nicht ein{k % 7}", "de") for k in range(60)] + [(f"word{k} and not one{k % 7}", "en") for k in range(60)]
    plain = L.fit(spark.createDataFrame(texts, schema))
    hot = L.fit(spark.createDataFrame(texts + [texts[0]] * 3000 + [texts[70]] * 500, schema).repartition(4))
    assert plain.langs == hot.langs and plain.words.keys() == hot.words.keys()
    assert all((plain.words[w] == hot.words[w]).all() for w in plain.words)
