import hashlib

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as C
from sluice.llm import bpe_words, lsa_decontam, pii_disclosure, toxicity_gru
from sluice.scratch import materialize
from test_lsa_decontam import pairs_by_hand
from test_near_shingles import components_by_hand
from test_pii_disclosure import by_hand as spans_by_hand


@pytest.fixture(scope="module")
def short_training():
    before, toxicity_gru.STEPS = toxicity_gru.STEPS, 30
    toxicity_gru.train.__kwdefaults__["steps"] = 30
    yield
    toxicity_gru.STEPS = toxicity_gru.train.__kwdefaults__["steps"] = before


def test_run_equals_brute_force(spark, sf_dir, documents, short_training):
    rows = {r.doc_id: r.text for r in documents.collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("crc32(string(doc_id)) % 3 <> 1")
    network = toxicity_gru.fit(documents, labels)
    ids = sorted(rows)
    scores = toxicity_gru._Scorer(network)([rows[i] for i in ids])
    ids = [i for i, s in zip(ids, scores) if s < 0.7]
    root = components_by_hand([(i, rows[i]) for i in ids])
    ids = [i for i in ids if root[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaking = {d for d, _ in pairs_by_hand([(i, rows[i]) for i in ids], items)}
    ids = [i for i in ids if i not in leaking]

    got = {r.doc_id: r for r in C.run(spark, sf_dir).collect()}
    assert sorted(got) == ids and 0 < len(ids) < len(rows)
    ranks = bpe_words.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i in ids:
        text = library.decode(list(got[i].ids))
        assert library.encode_ordinary(text) == list(got[i].ids) and got[i].n_tokens == len(got[i].ids)
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        spans = spans_by_hand(rows[i])
        assert (text == rows[i]) or spans or "hint]" in text
        if spans:
            assert spans_by_hand(text) == []


def test_stages(spark):
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "tokens"]
    assert C.ORACLE_SQL is None


def test_null_and_repeated_rows(spark, sf_dir, short_training):
    schema = "doc_id long, text string, lang string, source string, n_chars long, id long, component string, pii_note string"
    rows = [
        (1, None), (2, ""), (None, "some words here in a row"), (None, "some words here in a row"), (5, "some words here in a row"),
        (5, "some words here in a row"), (7, "mail a.b@example.org now please"), (8, "unlike the other texts of this table"),
    ]
    docs = materialize(spark.createDataFrame([(i, t, "en", None, len(t or ""), 1, "c", "n") for i, t in rows], schema).repartition(3), "docs")
    kept = C.near_duplicates(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5, 7, 8]
    assert C.decontamination(spark, docs, sf_dir).count() == len(rows)
    clean = {r.doc_id: (r.text, r.n_chars) for r in C.personal_data(spark, docs, sf_dir).collect()}
    assert clean[7] == ("mail [EMAIL] now please", 23) and clean[1] == (None, 0)
    assert C.toxicity(spark, docs, sf_dir).columns == docs.columns
    for _, stage in C.STAGES:
        assert stage(spark, docs.filter("false"), sf_dir).count() == 0


def test_tokens_has_one_worker_a_task(spark, sf_dir, documents, capsys):
    C.tokens(spark, documents, sf_dir).explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1


def test_tokens_sends_short_batches(spark, sf_dir, documents):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for rows, wanted in ((10_000, 500), (0, 500), (20, 20)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            C.tokens(spark, documents.limit(3), sf_dir)
            assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == wanted
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
