import random

from sluice.llm import near_shingles as N, simhash_gray
import corpus_pipeline as C
from sluice.scratch import materialize


def by_hand(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def components_by_hand(rows):
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, by_hand(t)) for i, t in rows]
    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if len(x & y) >= 0.8 * len(x | y):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i, _ in rows}


def test_components_equal_brute_force(spark, docs_of, sf_dir):
    draw = random.Random(3)
    rows = []
    for _ in range(60):  # groups of near copies, each made of the one before, in part beyond 0.8
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(30, 300))]
        for _ in range(draw.randint(1, 6)):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            for _ in range(max(1, int(len(words) * draw.choice([0.005, 0.015, 0.03])))):
                words[draw.randrange(len(words))] = "other"
    wanted = components_by_hand(rows)
    got = {}
    for r in N.near_duplicates(materialize(docs_of(rows), "docs")).collect():
        got.setdefault(r.component, []).append(r.id)
    assert sorted(map(sorted, got.values())) == sorted(sorted(i for i in wanted if wanted[i] == k) for k in set(wanted.values()))
    kept = C.near_duplicates(spark, materialize(docs_of(rows), "docs"), sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(wanted.values()))


def test_edge_rows(spark, docs_of):
    text = " ".join(f"w{k}" for k in range(60))
    near, long = text.replace("w59", "x"), " ".join(f"l{k}" for k in range(40_000))
    rows = [
        (1, None), (2, ""), (3, " \n"), (None, text), (None, near), (4, "two words"), (4, "Two Words"), (5, "two words"), (6, long), (6, long + " end"), (7, "alone"),
    ]
    docs = materialize(docs_of(rows), "docs")
    found = {}
    for r in N.near_duplicates(docs).collect():
        found.setdefault(r.component, []).append(r.id)
    assert sorted(sorted(map(str, g)) for g in found.values()) == [["1", "2", "3"], ["4", "4", "5"], ["6", "6"], ["7"], ["None", "None"]]
    assert N.near_duplicates(docs.filter("false")).collect() == []


def test_index_gives_candidates(spark, docs_of, monkeypatch):
    monkeypatch.setattr(N, "bands", lambda members: [])  # what is linked then, the index of fingerprints has found
    draw = random.Random(5)
    words = [f"w{draw.randrange(50_000)}" for _ in range(3000)]
    near = [*words[:-1], "other"]
    often, one, two = "a b c " * 400, " ".join(words[:40]), " ".join(words[40:80])
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, often + one), (4, often + two), (5, one), (6, two)]
    fps = [simhash_gray.fingerprint(t.encode()) for _, t in rows]
    assert 0 < (fps[0] ^ fps[1]).bit_count() <= 3 and (fps[2] ^ fps[3]).bit_count() <= 3
    found = {}
    for r in N.near_duplicates(materialize(docs_of(rows), "docs")).collect():
        found.setdefault(r.component, []).append(r.id)
    assert sorted(map(sorted, found.values())) == [[1, 2], [3], [4], [5], [6]]


def counted(monkeypatch):
    """Rows of what is stored, by label."""
    rows, store = {}, N.materialize

    def run(df, label, **more):
        stored = store(df, label, **more)
        rows[label] = rows.get(label, 0) + stored.count()
        return stored

    monkeypatch.setattr(N, "materialize", run)
    return rows


def test_group_of_copies_below_the_threshold_costs_few_pairs(spark, docs_of, monkeypatch):
    draw, common, rows = random.Random(7), [f"w{k}" for k in range(40)], []
    for i in range(200):  # each with two words of its own: any two share between 0.4 and 0.8
        words = list(common)
        for at in (draw.randrange(5, 18), draw.randrange(22, 35)):
            words[at] = f"own{i}-{at}"
        rows.append((i, " ".join(words)))
    stored = counted(monkeypatch)
    found = N.near_duplicates(materialize(docs_of(rows), "docs"))
    assert found.select("component").distinct().count() == len(set(components_by_hand(rows).values())) == 200
    assert stored["pairs"] < 5 * len(rows)


def test_bounds_hold(spark):
    draw = random.Random(11)
    for _ in range(300):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.randint(1, 200))]
        other = [w if draw.random() > 0.03 else "x" for w in words]
        x, y = (N.shingles(" ".join(w).encode()) for w in (words, other))
        only = len(set(x.tolist()) ^ set(y.tolist()))
        for bits in (64, 256):
            differ = int.from_bytes(N.parities(x, bits), "little") ^ int.from_bytes(N.parities(y, bits), "little")
            assert differ.bit_count() <= only
        frequent = (x[::3], [k % 5 + 2 for k in range(len(x[::3]))])
        frequent = (frequent[0], N.np.array(frequent[1]))
        both = len(set(x.tolist()) & set(y.tolist()))
        if both >= 0.8 * (len(x) + len(y) - both):
            assert set(N._first(x, frequent, 0.8).tolist()) & set(N._first(y, frequent, 0.8).tolist())
