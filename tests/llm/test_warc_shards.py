import hashlib
import os
from collections import Counter

import pytest

from check_oracle import compare, connect
from sluice.llm import warc_shards as W
from sluice.llm.queries import ORACLE, QUERIES

LONG = "<p>" + "é" * 60


@pytest.fixture
def pages_of(spark):
    def build(rows, parts=3):
        schema = "page_id long, url string, html string, digest string, page int, first long, verdict string"
        return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], schema).repartition(parts)

    return build


def test_query_equals_sql(spark, sf_dir):
    assert compare(QUERIES["op7_warc_shards"](spark, sf_dir), connect(sf_dir), ORACLE["op7_warc_shards"]) == ""


def test_edge_rows(spark, pages_of, tmp_path):
    rows = [
        (1, None, None), (2, "http://a/\r\nX: y", ""), (3, "u", LONG), (4, "u", LONG), (4, "u", LONG), (3, "v", LONG), (None, "n", LONG),
        (5, "short", "same"), (6, "short", "same"), (7, "ü b", "x\r\n\r\ny" * 50_000), (None, "n", "null twice " * 20), (None, "n", "null twice " * 20),
    ]
    W.write_archives(pages_of(rows), str(tmp_path / "a"))
    got = [tuple(r) for r in W.read_archives(spark, str(tmp_path / "a")).drop("url").collect()]

    def want(page, html, kind, refers):
        body = (html or "").encode()
        return (page, len(body), hashlib.sha256(body).hexdigest(), kind, refers, bytearray(body) if kind == "response" else None)

    wanted = [
        want(1, "", "response", None), want(2, "", "response", None), want(3, LONG, "response", None), want(3, LONG, "revisit", 3),
        want(4, LONG, "revisit", 3), want(4, LONG, "revisit", 3), want(None, LONG, "revisit", 3), want(5, "same", "response", None),
        want(6, "same", "response", None), want(7, rows[9][2], "response", None),
        want(None, "null twice " * 20, "response", None), want(None, "null twice " * 20, "response", None),
    ]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(wanted, key=key)


def test_files_roll_and_are_the_same_again(spark, pages_of, tmp_path):
    rows = [(i, f"http://x/{i}", os.urandom(600).hex()) for i in range(400)]
    frame = pages_of(rows)
    for name in ("a", "b"):
        manifest = W.write_archives(frame, str(tmp_path / name), roll_bytes=20_000)
        for r in manifest.collect():
            data = (tmp_path / name / r.final).read_bytes()
            assert (len(data), hashlib.sha256(data).hexdigest()) == (r.bytes, r.sha256) and r.bytes < 22_000
            assert sum(1 for _ in W.records(data)) == r.records + 1
        assert W.read_archives(spark, str(tmp_path / name)).count() == 400
    digests = [Counter(hashlib.sha256(f.read_bytes()).hexdigest() for f in (tmp_path / n).glob("*.gz")) for n in "ab"]
    assert sum(digests[0].values()) > 10 and digests[0] == digests[1]


def test_empty_table_and_damage(spark, pages_of, tmp_path):
    assert W.write_archives(pages_of([(1, "u", "x")]).filter("false"), str(tmp_path / "e")).count() == 0
    assert W.read_archives(spark, str(tmp_path / "e")).count() == 0
    data = W.gzip.compress(W.page_record(1, "u", b"abc", hashlib.sha256(b"abd").hexdigest(), None), mtime=0)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.warc.gz").write_bytes(data)
    with pytest.raises(Exception, match="payload of"):
        W.read_archives(spark, str(tmp_path / "bad")).collect()


def test_reader_takes_time_in_proportion(monkeypatch):
    import gzip

    pages = [W.record("response", [("N", str(k))], f"page {k} ".encode() * (k % 50)) for k in range(500)]
    data = b"".join(gzip.compress(p, 6, mtime=0) for p in pages)
    for size in (1, 7, 16_384, 10**9):
        monkeypatch.setattr(W, "_CHUNK", size)
        found = list(W.records(data))
        assert [h["n"] for h, _ in found] == [str(k) for k in range(500)]
        assert all(block == f"page {k} ".encode() * (k % 50) for k, (_, block) in enumerate(found))
        with pytest.raises(ValueError, match="cut off"):
            list(W.records(data[:-3]))
