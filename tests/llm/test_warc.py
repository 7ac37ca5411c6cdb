import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from snapmetrics.llm import warc as W

TRAP = "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"


@pytest.fixture(scope="module")
def rows():
    big, other = "x" * 999 + TRAP, "é漢😀\r\n" * 400
    return [(5, "http://a/", big), (9, "http://b/\r\nEvil: 1", big), (7, None, big), (1, "u", other), (2, "u", other), (3, "u", "short"), (4, "u", "short"),
            (6, "u", None), (8, "u", ""), (10, "u", "y" * 1000), (11, "u", "y" * 1000), (12, "u", "z" * 999), (13, "u", "z" * 999),
            (9, "http://b/", big), (None, "u", big)]


def brute(rows, least=1000):
    out = []
    body = lambda h: (h or "").encode()
    for i, _, h in rows:
        same = [j for j, _, g in rows if j is not None and body(g) == body(h)]
        again = len(body(h)) >= least and i is not None and i < max(same)
        out.append((i, len(body(h)), hashlib.sha1(body(h)).hexdigest(), "revisit" if again else "response", max(same) if again else None))
    return sorted(out, key=str)


def _read(spark, path):
    got = W.resolve(W.read_archives(spark, path)).select("rid", "bytes", "digest", "record_type", "refers_to")
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("most", [W.BROADCAST_ROWS, 0])
def test_archives_round_trip(spark, rows, tmp_path, monkeypatch, most):
    monkeypatch.setattr(W, "BROADCAST_ROWS", most)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(4)
    W.write_archives(W.records(pages), f"{tmp_path}/one")
    assert _read(spark, f"{tmp_path}/one") == brute(rows)
    full = W.read_archives(spark, f"{tmp_path}/one", payload=True).where("record_type = 'response'").collect()
    assert {r.payload for r in full} == {h or "" for _, _, h in rows}
    # Archives in, archives out: the same records again.
    W.deduplicate_archives(spark, f"{tmp_path}/one", f"{tmp_path}/two")
    named = [r for r in rows if r[0] is not None]
    assert [r for r in _read(spark, f"{tmp_path}/two") if r[0] is not None] == [r for r in brute(rows) if r[0] is not None]
    assert len(named) == len(rows) - 1


def test_record_format(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://x/", "a" * 1200), (2, "http://y/", "a" * 1200)], "page_id long, url string, html string").coalesce(1)
    W.write_archives(W.records(pages), str(tmp_path / "w"))
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(str(tmp_path / "w")).collect()]
    found = {f["WARC-Record-ID"]: (f, body) for data in files for f, body in W.parse(W.unzipped(data))}
    head, body = found["<urn:page:1>"]
    assert head["WARC-Type"] == "revisit" and head["WARC-Refers-To"] == "<urn:page:2>" and body == b"" and head["WARC-Profile"] == W.PROFILE
    head, body = found["<urn:page:2>"]
    assert head["WARC-Type"] == "response" and body == b"a" * 1200 and "WARC-Refers-To" not in head
    assert head["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(body).hexdigest()


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    W.write_archives(W.records(pages), str(tmp_path / "w"))
    assert W.resolve(W.read_archives(spark, str(tmp_path / "w"))).count() == 0


def test_revisits_without_their_response_stay(spark, tmp_path):
    """The archives hold revisits of records that are elsewhere, and an id
    with two payloads, of which a revisit names one by its digest."""
    a, b = "a" * 1500, "b" * 1500
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    rows = [(9, "u9", a, None, None), (9, "u9b", b, None, None), (3, "u3", "c" * 1200, None, None),
            (1, "u1", "", 77, sha("elsewhere")), (2, "u2", "", 9, sha(b)), (4, "u4", "", 9, sha("no such payload"))]
    recs = spark.createDataFrame(rows, "rid long, uri string, payload string, refers_to long, digest string")
    none = spark.createDataFrame([], "rid long, digest string, refers_to long")
    W._write(recs, none, f"{tmp_path}/one")
    W.deduplicate_archives(spark, f"{tmp_path}/one", f"{tmp_path}/two")
    got = {(r.rid, r.uri, r.record_type, r.digest, r.refers_to) for r in W.read_archives(spark, f"{tmp_path}/two").collect()}
    assert got == {
        (9, "u9", "response", sha(a), None), (9, "u9b", "response", sha(b), None), (3, "u3", "response", sha("c" * 1200), None),
        (1, "u1", "revisit", sha("elsewhere"), 77), (2, "u2", "revisit", sha(b), 9), (4, "u4", "revisit", sha("no such payload"), 9),
    }


def test_large_records_get_files_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "SIZE_CLASSES", [(100, 50), (1000, 3), (1 << 62, 1)])
    rows = [(i, "u", chr(97 + i % 26) * (i % 3 * 400 + i)) for i in range(60)]
    W.write_archives(W.records(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)), str(tmp_path / "w"))
    sizes = []
    for r in spark.read.format("binaryFile").load(str(tmp_path / "w")).collect():
        sizes.append([len(body) for _, body in W.parse(W.unzipped(bytes(r.content), 64))])
    assert all(len(s) <= (50 if max(s) < 100 else 3 if max(s) < 1000 else 1) for s in sizes if s)
    assert sorted(n for s in sizes for n in s) == sorted(len(t) for _, _, t in rows)


def test_pieces_of_any_size(rows):
    data = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\n\r\nh\r\n\r\n%s\r\n\r\n" % (len(t) + 5, t) for t in (b"", b"x" * 50, TRAP.encode()))
    packed = gzip.compress(data[:40]) + gzip.compress(data[40:])
    for piece in (1, 3, 1000):
        for whole in (data, packed):
            assert [body for _, body in W.parse(W.unzipped(whole, piece))] == [b"", b"x" * 50, TRAP.encode()]
    with pytest.raises(ValueError):
        list(W.parse(W.unzipped(packed[:-12], 10)))
    with pytest.raises(ValueError):
        list(W.parse([data[:-20]]))
