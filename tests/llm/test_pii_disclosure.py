import hashlib
import random
import re

import pytest

from sluice.llm import pii_disclosure as P
from sluice.llm.queries import QUERIES

# The patterns as they are stated, without the additions for speed.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def by_hand(text):
    spans = []
    for place, (kind, pattern) in enumerate(STATED.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 9 <= len(digits) <= 15
            ):
                spans.append((m.start(), place, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]


def test_query_equals_brute_force(spark, sf_dir, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = QUERIES["op8_pii_disclosure"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 10
    for r in rows:
        wanted = by_hand(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in wanted) for k in STATED]
        assert set(wanted) <= set(r.spans.split(",")) | {""} - {""} or not wanted


CASES = [
    None, "", "a@b.c.@d.e x", "a@@b.c a.b+c@d-e.f.g- .@x.y", "é a@b.co é1.2.3.4é 300.1.2.3.4 001.02.003.0255", "1.2.3.4.5.6.7.8.9 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4 4111111111111111", "41111111111111 11 2345678901234567890 12 34", "5 - 4242424242424242  4242424242424242",
    "+1 (222) 333-4444. +1 2 +12345678901234567 ++49 30 1234567 ", "\U0001f600 x@y.z \U0001f600 +44 20 7946 0958", "a" * 50_000 + "@", "1" * 50_000, "9 " * 30_000,
    "x@y.zz " * 300, "1.1.1." * 3000, "+1 " * 4000,
]


def test_cases(spark, docs_of):
    rows = [(k, t) for k, t in enumerate(CASES)] + [(4, CASES[4]), (None, "a@b.c")]
    got = sorted(((r.id, r.s) for r in P.find(docs_of(rows)).select("id", P.span_list(P.F.col("base")).alias("s")).collect()), key=str)
    assert got == sorted(((i, ",".join(by_hand(t))) for i, t in rows), key=str)
    assert P.find(docs_of(rows).filter("false")).count() == 0


def test_random_texts(spark, docs_of):
    draw = random.Random(4)
    rows = [(k, "".join(draw.choice("0123456789012345. -@+()aé") for _ in range(draw.randint(0, 120)))) for k in range(1500)]
    got = {r.id: r.s for r in P.find(docs_of(rows)).select("id", P.span_list(P.F.col("base")).alias("s")).collect()}
    assert got == {i: ",".join(by_hand(t)) for i, t in rows}


def test_disclosing_terms_and_clean_text(docs_of):
    fill = [f"{a}{b}" for a in ("alpha", "beta", "gamma", "delta") for b in ("one", "two", "six", "ten")]
    rows = [(k, f"{fill[k % 16]} words {fill[k * 7 % 16]} {''.join(chr(97 + int(d)) for d in str(k))}zzz") for k in range(400)]
    rows += [(1000 + k, f"{fill[k]} Rumpelstilz wrote {fill[k + 3]} from r.st@example.org to {fill[k + 5]}") for k in range(8)]
    rows += [(2000, "nobody knows rumpelstilz."), (2001, "call +1 222 333 4444 via 1.2.3.4"), (2001, "call +1 222 333 4444 via 1.2.3.4")]
    terms = {r.term: r for r in P.disclosing_terms(docs_of(rows), bits=5.0).collect()}
    assert "rumpelstilz" in terms and terms["rumpelstilz"].kind == "email" and not set(fill) & set(terms)
    clean = {r.doc_id: r.text for r in P.sanitise(docs_of(rows + [(3000, None)]), bits=5.0).collect()}
    assert clean[3000] is None
    assert clean[2000] == "nobody knows [email hint]."
    assert clean[2001] == "call [PHONE] via [IP]"
    assert "[EMAIL]" in clean[1000] and "example" not in clean[1000] and "Rumpel" not in clean[1000]
    assert all(clean[k] == t for k, t in rows if k < 400)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op8_pii_disclosure"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_columns_of_any_name_stay(spark):
    schema = "doc_id long, text string, pii_text string, PII_base string, pii_terms string, pii_held int, pii_content long, pii__text string"
    docs = spark.createDataFrame([(1, "mail a.b@example.org now", "t", "b", "m", 1, 2, "u"), (2, None, None, None, None, None, None, None)], schema)
    clean = P.sanitise(docs)
    assert clean.columns == docs.columns
    assert sorted(map(tuple, clean.collect()), key=str) == [(1, "mail [EMAIL] now", "t", "b", "m", 1, 2, "u"), (2, None, None, None, None, None, None, None)]
    with pytest.raises(ValueError, match="pii_base, pii_content"):
        P.with_spans(docs)
