import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from sluice.llm import simhash_gray as S
from sluice.llm.components import connected_components
from sluice.llm.queries import QUERIES


def by_hand(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(rows):
    ids = sorted(range(len(rows)), key=lambda i: rows[i][0])
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 3:
                p, q = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                root[q] = p
    return {i: rows[find(i)][0] for i in ids}


def test_query_equals_brute_force(spark, sf_dir, documents):
    rows = [(r.doc_id, by_hand(r.text)) for r in documents.collect()]
    root = components_by_hand(rows)
    wanted = sorted((i, f"{fp:016x}", root[k]) for k, (i, fp) in enumerate(rows))
    got = QUERIES["op2_simhash_near_dedup"](spark, sf_dir)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == wanted


def test_edge_rows(docs_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "a b"), (6, "a b"), (7, "é É"), (8, "x " * 40_000)]
    got = sorted((r.id, r.fp % 2**64, r.component) for r in S.near_duplicates(docs_of(rows)).collect())
    hashed = [(i, by_hand(t)) for i, t in rows]
    root = components_by_hand(hashed)
    assert got == sorted((i, fp, root[k]) for k, (i, fp) in enumerate(hashed))


def test_null_ids_and_empty_table(docs_of):
    got = S.near_duplicates(docs_of([(None, "a b c"), (3, "a b c"), (None, "q r s")])).collect()
    assert sorted((r.id is None, r.component is None, r.component or 0) for r in got) == [(False, False, 3), (True, False, 3), (True, True, 0)]
    assert S.near_duplicates(docs_of([(1, "a")]).filter("false")).count() == 0


@pytest.mark.parametrize("leaf", [64, 4096])
def test_links_connect_all_near_pairs(spark, leaf):
    draw = random.Random(5)
    fps = {draw.getrandbits(64) for _ in range(300)}
    centre = draw.getrandbits(64)
    for _ in range(1500):  # a dense group, whose nodes are longer than a leaf
        fps.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))))
    for x in list(fps)[:200]:
        fps.add(x ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 3))))
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    links = S.near_links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(5), leaf=leaf)
    pairs = [(r.a % 2**64, r.b % 2**64) for r in links.collect()]
    assert all(0 < bin(a ^ b).count("1") <= 3 for a, b in pairs)
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    every = np.array(sorted(fps), np.uint64)
    for x in every:
        near = every[np.bitwise_count(every ^ x) <= 3]
        assert len({find(int(y)) for y in near}) == 1


def test_components_of_chain_star_and_cycle(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 300)] + [(502, 501), (501, 500), (500, 502), (7, 7), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{k: 100 for k in range(100, 300)}, 500: 500, 501: 500, 502: 500}


def chain(size):
    """Each one differs from the next in three blocks; all lie in one node in the middle of the order."""
    draw, x, out = random.Random(size), random.Random(1).getrandbits(64), []
    while len(out) < size:
        if x not in out:
            out.append(x)
        x ^= 1 << draw.randrange(0, 12) | 1 << draw.randrange(39, 51) | 1 << draw.randrange(52, 64)
    return out


def lost_links(spark, fps, leaf):
    """Neighbours of the chain that the links of one task leave apart."""
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    root = {x: x for x in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in S.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), leaf=leaf).collect():
        root[find(r.a)] = find(r.b)
    every = np.array(fps, np.uint64)
    near = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(every ^ every[i]) <= 3).tolist()]
    return [p for p in near if find(signed[p[0]]) != find(signed[p[1]])]


def test_last_leaf_of_a_long_node(spark, conf):
    conf("spark.sql.shuffle.partitions", "1")
    for size in (66, 64 * 3 + 20, 64 * 5 + 32):
        assert lost_links(spark, chain(size), 64) == []


def test_node_over_several_batches():
    def rank(x):
        for shift in (1, 2, 4, 8, 16, 32):
            x ^= x >> shift
        return x - (1 << 63)

    for size in range(100, 400, 13):  # a node between two others of its task
        fps = sorted(chain(size), key=rank)
        rows = [(0, 0, 0, 5)] + [(4, 0, rank(x), x) for x in fps] + [(9, 0, 0, 6)]
        columns = [np.array(c, t) for c, t in zip(zip(*rows), ("i4", "i8", "i8", "u8"))]
        columns[3] = columns[3].view("i8")
        batches = [pa.RecordBatch.from_arrays([pa.array(c[at : at + 97]) for c in columns], list("mprf")) for at in range(0, len(rows), 97)]
        root, leaves = {x: x for x in fps + [5, 6]}, []

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for out in S._leaves(3, 64)(iter(batches)):
            for r in out.to_pylist():
                if r["members"] is None:
                    root[find(r["a"] % 2**64)] = find(r["b"] % 2**64)
                elif r["mask"] == 4:
                    leaves.append(np.frombuffer(r["members"], "<u8"))
        for k, left in enumerate(leaves):
            for right in leaves[:k]:
                for xs, ys in S.linked(left, right):
                    for x, y in zip(xs.tolist(), ys.tolist()):
                        root[find(x)] = find(y)
        assert len({find(x) for x in fps}) == 1, size
