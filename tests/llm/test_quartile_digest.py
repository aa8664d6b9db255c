import hashlib
from collections import Counter

import pytest

from sluice.llm import quartile_digest as Q
from sluice.llm.queries import QUERIES


def counts_by_hand(data):
    found = Counter()
    for i in range(len(data)):
        for second, third, salt in Q._TRIPLETS:
            if i + third < len(data):
                value = data[i] << 16 | data[i + second] << 8 | data[i + third]
                found[((value + (salt << 24)) * 2654435761 % 2**32) >> 25] += 1
    return [found[b] for b in range(128)]


def edits_by_hand(rows):
    out = []
    for k, (doc, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        mine, theirs = Q.digest(text.encode()), Q.digest(edited.encode())
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), mine, theirs, Q.likeness(mine, theirs), Q.likeness(mine, Q.digest(after.encode()))))
    return out


def test_query_equals_brute_force(spark, sf_dir, documents):
    rows = sorted((r.doc_id, r.text or "") for r in documents.collect())
    got = sorted(tuple(r) for r in QUERIES["op6_quartile_digest"](spark, sf_dir).collect())
    assert got == edits_by_hand(rows)
    edited, other = sum(r[5] for r in got) / len(got), sum(r[6] for r in got) / len(got)
    assert edited > other + 0.1


@pytest.mark.parametrize("data", [b"", b"a", b"abc", "éà € long enough".encode(), b"xyz" * 400])
def test_counts(data, monkeypatch):
    assert Q.triplet_counts(data).tolist() == counts_by_hand(data)
    monkeypatch.setattr(Q, "_CHUNK", 7)
    assert Q.triplet_counts(data).tolist() == counts_by_hand(data)


def test_likeness_is_bounded():
    a, b = Q.digest(b"the quick brown fox " * 50), Q.digest(bytes(range(256)) * 400)
    assert Q.likeness(a, a) == 1 and 0 <= Q.likeness(a, b) < 0.6 and Q.likeness(a, b) == Q.likeness(b, a)
    assert Q.digest(b"") == "00" * 34


def test_edge_rows(docs_of):
    rows = [(1, None), (2, ""), (3, "é"), (4, "ab"), (5, "long " * 30_000), (9, "xyz")]
    got = sorted(tuple(r) for r in Q.edited_fingerprints(docs_of(rows)).collect())
    assert got == edits_by_hand([(i, t or "") for i, t in rows])
    assert [tuple(r) for r in Q.edited_fingerprints(docs_of([(7, "alone")])).collect()] == edits_by_hand([(7, "alone")])
    assert Q.edited_fingerprints(docs_of(rows).filter("false")).count() == 0
    assert sorted(r.n_chars for r in Q.fingerprints(docs_of(rows)).collect()) == [0, 0, 1, 2, 3, 150_000]


def test_null_and_repeated_ids(docs_of):
    rows = [(None, "aa"), (None, "aa"), (3, "bbbb"), (3, "bbbb"), (3, "bbbb"), (4, "c")]
    got = [tuple(r) for r in Q.edited_fingerprints(docs_of(rows, 4)).collect()]
    assert Counter(got) == Counter(edits_by_hand(rows))
