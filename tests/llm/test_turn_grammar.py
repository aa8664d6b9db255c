import hashlib
import heapq
import random
import re
import zlib

import pytest

from sluice.llm import queries as Q, turn_grammar as G

SCHEMA = "conv_id long, turn long, role string, text string, conv string, number string, audit string, cost string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w", "k") for r in rows], SCHEMA).repartition(3)


def faults_by_hand(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least (cost, audit) among all ways to edit the rows, tried in the order of cost and audit, none left out."""
    ways = [(0, "", 0, "")]
    while True:
        cost, audit, i, last = heapq.heappop(ways)
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        legal = "a" if last == "u" else "u"
        heapq.heappush(ways, (cost + 3, audit + "I", i, legal))
        if i == len(rows):
            continue
        heapq.heappush(ways, (cost + 4, audit + "D", i + 1, last))
        if faults[i] not in ("blank", "duplicate"):
            stays, initial = cost + 3 * (faults[i] is not None), rows[i][1][:1]
            heapq.heappush(ways, (stays + 3, audit + "R", i + 1, legal))
            if initial == legal or (initial, last) == ("s", ""):
                heapq.heappush(ways, (stays, audit + "K", i + 1, initial))


def repaired_by_hand(rows, audit):
    out, i = [], 0
    for edit in audit:
        legal = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            out.append((legal, ""))
            continue
        if edit != "D":
            out.append((rows[i][1] if edit == "K" else legal, rows[i][2]))
        i += 1
    assert i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    return out


def by_hand(rows):
    """Rows (conv, turn, role, text) -> the expected row of each conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        faults = faults_by_hand(own)
        turns = [t for t, _, _ in own if t is not None]
        cost, audit = cheapest(own, faults)
        text = "\n".join(f"{r}:{x}" for r, x in repaired_by_hand(own, audit))
        initials = [r[:1] for _, r, _ in own]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def got(df, plans):
    found = {r.conv: r for r in G.summaries(df, plans).collect()}
    return {
        p.conv: (found[p.conv].gaps, p.blank, p.duplicate, p.truncated, found[p.conv].illegal, p.cost, p.audit, found[p.conv].repaired_sha256)
        for p in plans.collect()
    }


def random_rows(draw, conversations, longest):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Good.", "Fine!", "cut off", "cut , \n", "", " \t", None, "Why?  ", "é.", "x" * 30]
    return [
        (c, draw.choice([None, k, k, k, k * 2]), draw.choice(roles), draw.choice(texts)) for c in conversations for k in range(draw.randint(1, longest))
    ]


@pytest.mark.parametrize("block, fan", [(512, 32), (3, 2)])
def test_equals_brute_force(spark, monkeypatch, block, fan):
    monkeypatch.setattr(G, "BLOCK", block)
    monkeypatch.setattr(G, "FAN", fan)
    rows = random_rows(random.Random(block), [*range(80), None], 6)
    df = frame(spark, rows)
    assert got(df, G.plan(df)) == by_hand(rows)


def test_matrix_product_is_associative():
    draw = random.Random(4)
    for _ in range(200):
        letters = [draw.choice(G._LETTERS) for _ in range(draw.randint(3, 12))]
        ms = [G.terminal(c) for c in letters]
        left = ms[0]
        for m in ms[1:]:
            left = G.times(left, m)
        while len(ms) > 1:
            k = draw.randrange(len(ms) - 1)
            ms[k : k + 2] = [G.times(ms[k], ms[k + 1])]
        assert ms[0] == left


def test_long_repeated_and_empty_conversations(spark):
    long = [(1, k, "user" if k % 2 == 0 else "assistant", f"{k}.") for k in range(3000)]
    copies = [(2, 5, "user", "same.")] * 400
    rows = [*long, *copies, (3, 1, "user", ""), (4, 1, "system", "Be brief."), (5, 1, "user", "z" * 200_000)]
    df = frame(spark, rows)
    plans = G.plan(df, frame(spark, [(c, None, None, None) for c in (1, 2, 3, 4, 5, 6, None)]))
    found = got(df, plans)
    assert found[1][5:7] == (0, "K" * 3000)
    assert found[2][1:7] == (0, 399, 0, 399, 3 + 4 * 399, "K" + "D" * 399 + "I")
    assert found[3][5:7] == (4, "D") and found[4][5:7] == (4, "D") and found[5][3:7] == (1, 0, 4, "D")
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[6] == found[None] == empty and found[3][7] == empty[7]
    turns = sorted((r.place, r.role, r.edit) for r in G.repaired(df, plans).filter("conv = 2").collect())
    assert turns == [(1, "user", "K"), (2, "assistant", "I")]
    none = df.filter("false")
    assert G.plan(none).collect() == [] and got(none, G.plan(none, df))[1] == empty


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in (*range(30), None) for t in (None, *range(8))]
    wanted = []
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if h == 4 else role, "" if h == 1 else "One Two" if h == 2 else text)
        wanted += [row] * (0 if h == 0 else 2 if h == 3 else 1)
    found = [(r.conv_id, r.turn, r.role, r.text) for r in Q._damaged_turns(frame(spark, rows)).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str) and len({w[3] for w in wanted}) == 3
