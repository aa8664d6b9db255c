import hashlib
import random
import sys
import tracemalloc
import unicodedata

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from sluice.llm import bpe_words as B
from sluice.llm.queries import QUERIES

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def wanted(library, rows):
    out = []
    for doc, text in rows:
        ids = library.encode_ordinary(text or "")
        out.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return out


def test_query_equals_library(spark, sf_dir, documents, library):
    got = QUERIES["op4_byte_bpe"](spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted(map(tuple, got.collect())) == sorted(wanted(library, rows))


def test_merges_of_any_length(ranks, library):
    draw = random.Random(3)
    for n in [1, 2, 3, 10, 40, 63, 64, 65, 66, 200, 3000]:
        for letters in ("ab", "etaoin srhl", "éüß the"):
            word = "".join(draw.choice(letters) for _ in range(n)).encode()
            assert B.merge(word, ranks) == library._encode_single_piece(word)
    assert B.merge(b"a" * 5000, ranks) == library._encode_single_piece(b"a" * 5000)


def test_every_character_is_cut_as_by_the_library(library):
    find = B.regex.compile(P.PATTERN).findall
    differ = []
    for c in range(sys.maxunicode + 1):
        if 0xD800 <= c < 0xE000 or unicodedata.category(chr(c)) in ("Cn", "Co"):
            continue
        text = f"a{chr(c)}b {chr(c)} 1{chr(c)}"
        ids = [i for w in find(text) for i in library._encode_single_piece(w.encode())]
        if ids != library.encode_ordinary(text):
            differ.append(hex(c))
    assert differ == []


def test_edge_rows(docs_of, library):
    rows = [(1, None), (2, ""), (3, "   "), (4, "a" * 20_000), (5, "it's  \n\n two"), (5, "it's  \n\n two"), (None, "null id"), (6, "x y " * 30_000)]
    encoded = B.encode(docs_of(rows), PATH, P.PATTERN)
    got = [(r.id, list(r.ids), bytes(r.data).decode()) for r in B.decode(encoded, PATH).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(((i, library.encode_ordinary(t or ""), t or "") for i, t in rows), key=key)
    assert B.encode(docs_of(rows).filter("false"), PATH, P.PATTERN).count() == 0


def test_decode_keeps_other_columns(spark):
    frame = spark.createDataFrame([(1, None, "x"), (2, [], "y"), (3, [64, 65], None)], "a long, ids array<int>, `odd name` string")
    table = {i: t for t, i in B.read_ranks(PATH).items()}
    got = [tuple(r) for r in B.decode(frame, PATH).orderBy("a").collect()]
    assert got == [(1, None, "x", None), (2, [], "y", bytearray()), (3, [64, 65], None, bytearray(table[64] + table[65]))]


def test_decode_closes_batches_by_ids(spark, monkeypatch):
    lists = [[64] * 4, None, [], [65] * 7, [66], [67] * 25, [], None, [68] * 3]
    rows = pa.RecordBatch.from_arrays([pa.array(range(9), pa.int64()), pa.array(lists, pa.list_(pa.int32()))], names=["id", "ids"])
    frame = spark.createDataFrame([], "id long, ids array<int>")
    monkeypatch.setattr(B, "_IDS", 10, raising=False)
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, schema: run)
    table = {i: t for t, i in B.read_ranks(PATH).items()}
    for whole in (rows, rows.slice(3), rows.slice(9)):
        got = list(B.decode(frame, PATH)(iter([whole])))
        assert all(sum(map(len, filter(None, b.column(1).to_pylist()[1:]))) < 10 for b in got)
        wanted = [r | {"data": None if r["ids"] is None else b"".join(table[i] for i in r["ids"])} for r in whole.to_pylist()]
        assert [r for b in got for r in b.to_pylist()] == wanted
    assert len(list(B.decode(frame, PATH)(iter([rows])))) > 1


def test_cut_holds_few_pre_tokens_at_a_time(monkeypatch):
    find = B.regex.compile(P.PATTERN).findall
    texts = [f"ab{k}\n cd\n " * 400 for k in range(1000)]
    tracemalloc.start()
    words, numbers = B._cut(texts, find, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 70_000_000  # 86 MB with all 2,000,000 of them
    words = words.to_pylist()
    assert [[words[n] for n in found] for found in numbers[::100]] == [find(t) for t in texts[::100]]
    monkeypatch.setattr(B, "_TOKENS", 3)
    few, places = B._cut(texts[:20], find, False)
    assert [few.take(pa.array(found)).to_pylist() for found in places] == [find(t) for t in texts[:20]]


@pytest.mark.parametrize("spaced", [True, False])
def test_cuts_at_spaces_change_nothing(docs_of, library, spaced):
    draw = random.Random(8)
    letters = [" ", " ", " ", "a", "b", "'", "s", "1", ".", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\x85", "\v", "é", "😀", "\u200b"]
    rows = [(k, "".join(draw.choice(letters) for _ in range(draw.randint(0, 60)))) for k in range(300)]
    got = {r.id: list(r.ids) for r in B.encode(docs_of(rows), PATH, P.PATTERN, spaced=spaced).collect()}
    assert got == {k: library.encode_ordinary(t) for k, t in rows}
