import re
from collections import defaultdict

import pytest

from sluice.llm import license_diagonals as D
from sluice.llm.queries import QUERIES


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(text):
    words, base, labels, best = words_of(text), [], set(), 0.0
    for label, phrase in D.PHRASES:
        parts = phrase.split()
        base += [(k, label) for k in range(len(words)) if words[k : k + len(parts)] == parts]
    for exact, (label, notice) in [(True, p) for p in D.PHRASES] + [(False, n) for n in D.NOTICES]:
        parts = notice.split()
        found = defaultdict(set)
        for k in range(len(words) - 1):
            for i in range(len(parts) - 1):
                if words[k : k + 2] == parts[i : i + 2]:
                    found[k - i].add(i)
        groups = []
        for start in sorted(found):
            if groups and not exact and start - groups[-1][0] <= D.DRIFT:
                groups[-1] = (start, groups[-1][1] | found[start])
            else:
                groups.append((start, found[start]))
        for _, places in groups:
            share = len(places) / (len(parts) - 1)
            best = max(best, share)
            if not exact and share >= D.COVERAGE:
                labels.add(label)
    names = {label for _, label in base}
    starts = [k for k, _ in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(names)), ",".join(sorted(names | labels)), best,
    )


def test_query_equals_brute_force(spark, sf_dir, documents):
    wanted = sorted((r.doc_id, *by_hand(r.text)) for r in documents.collect())
    got = sorted(tuple(r) for r in QUERIES["op9_license_diagonals"](spark, sf_dir).collect())
    assert [g[:-1] for g in got] == [w[:-1] for w in wanted]
    assert [g[-1] for g in got] == pytest.approx([w[-1] for w in wanted])
    assert {"cc-by-nc-4.0", "apache", "mit-notice"} <= set(",".join(g[-2] for g in got).split(","))


def test_edge_rows(docs_of):
    notice = D.NOTICES[3][1]
    rows = [
        (1, None), (2, ""), (3, "mit"), (4, "MIT License MIT license, the MIT; LICENSE"), (4, "general public license"), (5, "lorem " * 40_000 + "Apache  License"),
        (6, "mit license"), (6, "mit license"), (None, "mit license"), (7, "miT liKense mit lizense general\x00public\nlicense"),
        (8, notice), (9, notice.replace("binary forms", "binary and other forms")), (10, notice.replace("without ", "")), (11, notice[:60]),
        (12, "Ünder the MITé license license mit"), (13, f"{notice} {notice}"),
    ]
    got = sorted(((r.id, r.n_words, [(s.start, s.label) for s in r.spans if s.exact], sorted({s.label for s in r.spans}), round(r.score, 6)) for r in D.scan(docs_of(rows)).collect()), key=str)
    wanted = []
    for i, text in rows:
        n, _, _, _, _, labels, score = by_hand(text)
        words = words_of(text)
        base = sorted((k, label) for label, p in D.PHRASES for k in range(len(words)) if words[k : k + len(p.split())] == p.split())
        wanted.append((i, n, base, [x for x in labels.split(",") if x], round(score, 6)))
    assert got == sorted(wanted, key=str)
    assert D.scan(docs_of(rows).filter("false")).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op9_license_diagonals"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_templates_of_any_length(spark, docs_of):
    long = [f"t{k}" for k in range(300)]
    gone = [w for k, w in enumerate(long) if k % 40 != 7]
    notices = [("whole", " ".join(long)), ("edge", " ".join(f"e{k}" for k in range(65)))]
    rows = [
        (1, " ".join(["x"] * 9 + long + ["y"])), (2, " ".join(gone)), (3, " ".join(long[:200])), (4, " ".join(f"e{k}" for k in range(65))), (5, " ".join(long * 2)),
    ]
    found = {r.id: r for r in D.scan(docs_of(rows), phrases=[], notices=notices).collect()}
    spans = {i: [(s.start, s.words, s.label) for s in r.spans] for i, r in found.items()}
    assert spans[1] == [(9, 300, "whole")] and spans[4] == [(0, 65, "edge")] and spans[5] == [(0, 300, "whole"), (300, 300, "whole")]
    assert found[1].score == found[4].score == found[5].score == 1.0 and spans[3] == [] and round(found[3].score, 3) == round(199 / 299, 3)
    assert [s[2] for s in spans[2]] == ["whole"] and 0.9 < found[2].score < 1
