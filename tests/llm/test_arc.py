import hashlib
from decimal import Decimal
import zlib

import pytest

from goldleaf.llm import arc
from goldleaf.session import scratch_path


def brute(rows):
    first, out = {}, []
    pay = [((h or "").encode(), p) for p, _, h in rows]
    for b, p in pay:
        if len(b) >= 100:
            first[b] = p if b not in first else min(first[b], p, key=lambda x: (x is None, x))
    used = set()
    for b, p in sorted(pay, key=lambda x: (x[1] is None, x[1] or 0)):
        d = hashlib.sha256(b).hexdigest()
        again = len(b) >= 100 and (p != first[b] or b in used)
        used.add(b)
        out.append((p, len(b), d, "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


def test_archive_round_trip(spark):
    long = "<p>é</p>" * 40
    rows = [(5, "http://a/ b", long), (3, None, long), (9, "u", long), (9, "u", long), (7, "u", "short"), (8, "u", "short"), (1, "u", None), (2, "u", ""),
            (None, "n", long), (4, "x", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9), (6, "y", "y" * 100), (10, "y", "y" * 99), (11, "y", "y" * 99)]
    rows += [(100 + i, f"u{i}", "x" * 50 * (i % 7)) for i in range(40)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, id string").repartition(5)
    got = arc.archive_pages(df).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)
    assert {r.url for r in got if r.page_id in (5, 3)} == {"http://a/%20b", "urn:page:3"}
    assert arc.archive_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_parsing_declared_lengths_and_damage(version):
    rec = lambda u, body, v=version: arc.arc_line(v, u, "1.2.3.4", "19990102030405", "text/html", body, "f.arc") + body + b"\n"
    head = f"{version} 0 x\n{arc.FIELDS[version]}\n".encode()
    file = arc.arc_line(version, "filedesc://f", "0.0.0.0", "19990102030405", "text/plain", head, "f") + head + b"\n"
    data = file + rec("http://a", b"one\ntwo http://b 1.2.3.4 19990102030405 text/html 3\n") + b"not a record line\n" + rec("http://b", b"") + rec("http://c", b"12345678")[:-4]
    for raw in (data, b"".join(arc._gzip(p) for p in (data[:50], data[50:]))):
        got = [(r[1], r[2], r[4], r[5], len(r[6]), r[7]) for r in arc.parse_arc(raw)]
        assert got[0] == (version, "http://a", "19990102030405", "text/html", 52, True)
        assert got[1][1:] == ("http://b", "19990102030405", "text/html", 0, True)
        assert got[2][1] == "http://c" and not got[2][5]


def test_converted_records(spark):
    """A foreign archive with a DNS record: resource, identifiers, dates and digests."""
    folder, out = scratch_path(spark, "foreign"), scratch_path(spark, "foreign-warc")
    fs, base = arc.pa.fs.FileSystem.from_uri(folder)
    fs.create_dir(base)
    page = arc.http_response(b"z" * 200, {})
    data = b"".join(arc.arc_line(1, u, "9.9.9.9", d, m, b, "") + b + b"\n" for u, d, m, b in [
        ("dns:x", "20030405060708", "text/dns", b"20030405 x"), ("http://x/1", "20030405060709", "text/html", page), ("http://x/2", "20030405060708", "text/html", page)])
    with fs.open_output_stream(f"{base}/f.arc.gz", compression=None) as f:
        f.write(data)
    report = spark.createDataFrame([("f.arc.gz", 3)], "file string, n long")
    done = arc.convert(spark, folder, report, out)
    fs, base = arc.pa.fs.FileSystem.from_uri(out)
    raw = arc.gunzip_all(fs.open_input_file(f"{base}/f.warc.gz").read())
    assert zlib.crc32(raw)
    heads = [h for h, _ in arc.parse_warc(raw)]
    assert [h["WARC-Type"] for h in heads] == ["warcinfo", "resource", "revisit", "response"]
    assert heads[2]["WARC-Refers-To"] == heads[3]["WARC-Record-ID"] and heads[2]["WARC-Refers-To-Date"] == "2003-04-05T06:07:08Z"
    assert heads[1]["Content-Type"] == "text/dns" and heads[1]["WARC-Date"] == "2003-04-05T06:07:08Z"
    assert heads[3]["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(b"z" * 200).hexdigest()
    assert len({h["WARC-Record-ID"] for h in heads}) == 4
    assert arc.read_warc(spark, out, done).count() == 3


@pytest.mark.parametrize("kind,ids,least", [("long", [10 ** 18 + 5, 10 ** 18 + 3, 10 ** 18 + 4], 10 ** 18 + 3), ("long", [7, -3, 2], -3), ("string", ["b", "a", "10"], "10"),
                                            ("decimal(30,0)", [Decimal(10 ** 25 + 1), Decimal(10 ** 25)], Decimal(10 ** 25))])
def test_ids_are_compared_in_their_own_type(spark, kind, ids, least):
    df = spark.createDataFrame([(i, f"http://x/{n}", "same " * 40) for n, i in enumerate(ids)], f"page_id {kind}, url string, html string").coalesce(1)
    got = {r["page_id"]: r["refers_to"] for r in arc.archive_pages(df).collect()}
    assert got == {i: None if i == least else least for i in ids}


def test_odd_record_lines_are_read_and_others_counted():
    body = b"<p>x</p>"
    data = (b"http://a/with raw space 1.2.3.4 1999 text/html 8\n" + body + b"\n" + b"ftp://b 1.2.3.4 200102030405 no-type 8\n" + body + b"\nnoise 12\n\n"
            + b"http://c - 19990102030405  8\n" + body + b"\n")
    skipped = []
    got = [(r[2], r[3], r[4], r[5], r[6]) for r in arc.parse_arc(data, skipped)]
    assert got == [("http://a/with raw space", "1.2.3.4", "1999", "text/html", body), ("ftp://b", "1.2.3.4", "200102030405", "no-type", body),
                   ("http://c", "-", "19990102030405", "", body)]
    assert skipped == [8] and arc.iso_date("1999") == "1999-01-01T00:00:00Z" and arc.iso_date("200102030405") == "2001-02-03T04:05:00Z"


def test_members_after_padding_and_damage_are_read():
    a, b = arc._gzip(b"first"), arc._gzip(b"second" * 5000)
    assert arc.gunzip_all(a + b"\0" * 700 + b) == b"first" + b"second" * 5000
    assert arc.gunzip_all(a + b"\x1f\x8b\x08 no member" + b) == b"first" + b"second" * 5000
