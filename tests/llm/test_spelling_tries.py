import random
import zlib

import pytest

from sluice.llm import queries as Q, spelling_tries as S


def near_by_hand(words):
    """word -> set of words at distance one, by comparison of all pairs."""

    def one(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]

    return {a: {b for b in words if one(a, b)} for a in words}


def by_hand(counts, factor=5):
    near, form = near_by_hand(counts), {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, counts[w], len(near[w]), form[w], counts.get(form[w]), root(w)) for w in counts}


def got(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def random_words(draw, size):
    """Dense neighbourhoods over few letters, in part beyond Latin, with chains of forms."""
    counts = {}
    while len(counts) < size:
        word = "".join(draw.choice("abé𝒳") for _ in range(draw.randint(1, 6)))
        counts[word] = draw.choice([1, 1, 2, 6, 30, 31, 160])
    return counts


@pytest.mark.parametrize("chunk", [2, 7, 1024])
def test_variants_equal_all_pairs(spark, monkeypatch, chunk):
    # Small chunks: heads of heads, and prefixes that reach over several chunks.
    monkeypatch.setattr(S, "CHUNK", chunk)
    counts = random_words(random.Random(chunk), 150)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert got(S.variants(df)) == by_hand(counts)


def test_edge_rows(spark):
    schema = "word string, n long, rank long, p string, s string, own string, root string, place int"
    rows = [("", 1), ("a", 5), ("a", 2), (None, 9), ("ab", None), ("x" * 3000, 4), ("x" * 2999, 30), ("same", 3), ("sane", 3), ("sale", 15), ("sole", 75)]
    df = spark.createDataFrame([(w, n, 1, "p", "s", "o", "r", 2) for w, n in rows], schema)
    counts = {}
    for w, n in rows:
        if w is not None:
            counts[w] = counts.get(w, 0) + (n or 0)
    found = got(S.variants(df))
    assert found == by_hand(counts)
    assert {r[0]: r[5] for r in found}["sane"] == "sole"  # by way of sale
    assert got(S.variants(df.filter("false"))) == set()
    assert got(S.variants(df.filter("word = 'same'"))) == {("same", 3, 0, None, None, "same")}


def test_one_word_in_very_many_variants(spark):
    # Every variant meets the others in one pair of nodes.
    counts = {f"word{chr(c)}tail": 1 for c in range(0x4E00, 0x4E00 + 1500)} | {"wordtail": 9}
    found = {r[0]: r for r in got(S.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))}
    assert found["wordtail"][2:5] == (1500, None, None)
    assert found["word一tail"][2:] == (1500, "wordtail", 9, "wordtail")


def test_damaged_words(spark, docs_of):
    draw = random.Random(5)
    texts = [(i, " ".join(draw.choice(["Übung", "ÉcolesÄrzte", "Streets", "MARKET", "x-rayed", "a1bcdefg2", "señorita×s"]) + draw.choice(["", ",", "77"]) for _ in range(80))) for i in range(60)]
    wanted = {}
    import re

    for i, text in [*texts, (None, "orphan orphan orphan orphan orphan"), (9, None), (10, "")]:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 199 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            wanted[low] = wanted.get(low, 0) + 1
    wanted = {w: n for w, n in wanted.items() if len(w) >= 6 and n >= 5}
    docs = docs_of([*texts, (None, "orphan orphan orphan orphan orphan"), (9, None), (10, "")])
    assert {r.word: r.n for r in Q._damaged_words(docs).collect()} == wanted and len(wanted) >= 6
