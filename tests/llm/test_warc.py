import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql.datasource import EqualTo, In

from strataloom.llm import warc


def rows():
    big = "<html>" + "é x" * 100
    out = [(5, "http://a/1", big), (3, "http://a/2", big), (9, "http://b/ü\r\nX: y", big + "!"), (4, None, "tiny"), (6, "http://a/3", "tiny"), (7, "u", None), (8, "u", "")]
    return out + [(3, "http://a/2", big), (10, "v", "WARC/1.1\r\n\r\nWARC-Type: x\r\n\r\n" * 50), (None, "w", big), (11, "long", "z" * 300000)]


def want():
    out = []
    for i, _, t in rows():
        b = (t or "").encode()
        same = [j for j, _, u in rows() if u == t and j is not None]
        again = len(b) >= 100 and same and i != min(same)
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(*r, "x") for r in rows()], "page_id long, url string, html string, payload string").repartition(3)
    path = f"file://{tmp_path}/a"
    warc.archive_pages(df, path, fileBytes=2000)
    assert sorted((tuple(r) for r in warc.read_pages(spark, path).collect()), key=str) == want()
    assert not [p for p in (tmp_path / "a").iterdir() if p.name.startswith("_")]
    every = warc.read_warc(spark, path, decode="none")
    assert {r.record_type for r in every.collect()} == {"warcinfo", "response", "revisit"}
    some = warc.read_warc(spark, path, partitionBytes=100).where("record_type = 'response' and target_uri like 'http://a/%'")
    assert sorted(bytes(r.payload) for r in some.collect()) == sorted(t.encode() for i, u, t in rows() if (i, u) in ((3, "http://a/2"), (6, "http://a/3")))
    assert some.count() == 3
    named = warc.read_warc(spark, path, headers="WARC-Profile,content-type").where("header_warc_profile is not null and header_content_type is null")
    assert named.count() == sum(w[3] == "revisit" for w in want())  # they have no content
    named = warc.read_warc(spark, path, headers="content-type").where("header_content_type = 'application/warc-fields'")
    assert {r.record_type for r in named.collect()} == {"warcinfo"}
    assert warc.read_warc(spark, path).where("headers['warc-type'] = 'revisit'").count() == sum(w[3] == "revisit" for w in want())


def test_unwanted_payloads_are_not_inflated(tmp_path, monkeypatch):
    """The reader takes predicates on types and named headers for itself, and inflates what they leave."""
    blocks = [(b"response", b"a/b", b"x" * 9000), (b"metadata", b"c/d", b"y" * 9000), (b"response", b"c/d", b"z" * 9000)]
    data = b"".join(warc.member(b"WARC/1.1\r\nWARC-Type: %s\r\nContent-Type: %s\r\nX-Own: 7\r\nContent-Length: %d" % (k, c, len(x)), x, 6) for k, c, x in blocks)
    (tmp_path / "a.warc.gz").write_bytes(data)
    taken, real = [], warc._Gzip.take
    monkeypatch.setattr(warc._Gzip, "take", lambda self, n: taken.append(n) or real(self, n))
    for tests, left in (([], 3), ([EqualTo(("record_type",), "response")], 2), ([EqualTo(("header_content_type",), "c/d")], 2), ([EqualTo(("record_type",), "response"), In(("header_content_type",), ("c/d", "q"))], 1), ([EqualTo(("header_x_own",), "8")], 0)):
        reader = warc.WarcReader({"path": str(tmp_path), "headers": "Content-Type, X-Own"})
        assert list(reader.pushFilters(tests)) == []
        taken.clear()
        got = [r for p in reader.partitions() for r in reader.read(p)]
        assert len(got) == len(taken) == left
        assert all(r[-1] == "7" for r in got)
    assert list(warc.WarcReader({"path": ""}).pushFilters([EqualTo(("headers", "x-own"), "7")])) != []


def test_large_files_are_split_at_members(spark, tmp_path):
    rng = random.Random(1)
    pages = [(i, f"http://h/{i}", "".join(rng.choices("abcdef <>", k=rng.randint(0, 5000)))) for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    warc.archive_pages(df, f"file://{tmp_path}/a")
    whole = warc.read_warc(spark, f"file://{tmp_path}/a", split="false").orderBy("record_id").collect()
    parts = warc.read_warc(spark, f"file://{tmp_path}/a", partitionBytes=30_000)
    assert parts.rdd.getNumPartitions() > 5
    assert parts.orderBy("record_id").collect() == whole


def test_a_changed_payload_is_an_error(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\n\r\nother"
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:1>\r\nWARC-Payload-Digest: sha256:00\r\nContent-Type: application/http\r\nContent-Length: %d" % len(body)
    (tmp_path / "a.warc.gz").write_bytes(warc.member(head, body, 6))
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_pages(spark, f"file://{tmp_path}").collect()
    head = b"WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:x-page:2>\r\nWARC-Refers-To: <urn:x-page:1>\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 0"
    (tmp_path / "a.warc.gz").write_bytes(warc.member(head, b"", 6))
    with pytest.raises(Exception, match="revisit of no response"):
        warc.read_pages(spark, f"file://{tmp_path}").collect()


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_round_trip(df).count() == 0


def plain():
    out = b""
    for i, body in enumerate((b"one", b"HTTP/1.1 200 OK\r\n\r\n\r\n\r\ntwo", b"")):
        kind = b"application/http; msgtype=response" if i == 1 else b"text/plain"
        out += b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: <http://x/%d>\r\nWARC-Record-ID:\r\n <urn:%d>\r\nContent-Type: %s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, i, kind, len(body), body)
    return out


@pytest.mark.parametrize("kind", ["plain", "members", "sized"])
def test_other_archives(kind):
    parts = [b"WARC/" + p for p in plain().split(b"WARC/")[1:]]
    if kind == "plain":
        data = plain()
    elif kind == "members":
        data = b"".join(gzip.compress(p) for p in parts)
    else:
        data = b"".join(warc.member(*p[:-4].split(b"\r\n\r\n", 1), 6) for p in parts)
    got = list(warc.records(io.BytesIO(data), lambda h: True, "payload"))
    assert [r[8] for r in got] == [b"one", b"\r\n\r\ntwo", b""]
    assert [r[2] for r in got] == ["http://x/0", "http://x/1", "http://x/2"]
    assert [r[1] for r in got] == ["urn:0", "urn:1", "urn:2"]
    for k in range(3):
        (one,) = warc.records(io.BytesIO(data), lambda h: h["warc-target-uri"] == f"<http://x/{k}>", "digest")
        assert one[6] == len(got[k][8]) and one[8] is None
    with pytest.raises((ValueError, EOFError)):
        list(warc.records(io.BytesIO(data[: len(data) // 2]), lambda h: True, "payload"))
