import base64
import hashlib
import random

import pytest

from millrace.llm import archives
from millrace.llm.archives import OP12_SQL, archive_records, described, op12_warc, read_archives, write_archives
from millrace.llm.frames import saved
from oracle import connect, difference


def plain_read(data):
    """The records of an archive, followed one by one: (at, header, payload)."""
    out, at = [], 0
    while data[at:at + 5] == b"WARC/":
        end = data.index(b"\r\n\r\n", at) + 4
        size = next(int(line.split(b":")[1]) for line in data[at:end].split(b"\r\n") if line.lower().startswith(b"content-length:"))
        out.append((at, data[at:end].decode(), data[end:end + size]))
        at = end + size + 4
    return out


def record(payload, kind="resource", extra=""):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\n{extra}content-length:{len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"


PAYLOADS = [b"", b"plain", b"\r\n", b"\r\n\r\n", b"a\r\n\r\n\r\n", b"\n\nWARC/1.1\r\n", record(b"inner"), b"x\r\n\r\n" + record(record(b"deep")) + b"tail",
            b"\r\n" + record(b"q" * 500)[:-300], bytes(range(256)) * 3, b"z" * 3000, b"Name: value\r\n" * 40, b"WARC/1.1\r\nContent-Length: 5\r\n" + b"A: b\r\n" * 50]


def split_every(spark, monkeypatch, size, rows=10_000):
    """Has archives, but not the tables made on the way, read in blocks of ``size`` bytes."""
    scan, names = archives.scanned, ("spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")

    def scanned(session, folder):
        old = [session.conf.get(n) for n in names]
        for name, value in zip(names, (size, rows), strict=True):
            session.conf.set(name, str(value))
        try:
            return saved(scan(session, folder), "pieces")
        finally:
            for name, value in zip(names, old, strict=True):
                session.conf.set(name, value)

    monkeypatch.setattr(archives, "scanned", scanned)


@pytest.mark.parametrize("split", [64, 300, 5000, 1 << 20])
def test_reads_any_archive_cut_anywhere(spark, tmp_path, monkeypatch, split):
    split_every(spark, monkeypatch, split, 7)
    pick = random.Random(split)
    files = []
    for k in range(3):
        parts = [record(pick.choice(PAYLOADS), extra="X-Note: " + "n" * pick.choice((0, 90, 400)) + "\r\n") for _ in range(8)]
        files.append(b"".join(parts))
    files += [record(p) for p in PAYLOADS] + [b"", b"no archive\r\n\r\nWARC/1.1\r\nContent-Length: 1\r\n\r\nx\r\n\r\n", record(b"cut off")[:-9]]
    for k, data in enumerate(files):
        (tmp_path / f"{k}.warc").write_bytes(data)
    got = {}
    for r in read_archives(spark, str(tmp_path)).collect():
        got.setdefault(int(r["file"].split("/")[-1].split(".")[0]), []).append((r["at"], r["header"], bytes(r["payload"])))
    want = {k: plain_read(data) for k, data in enumerate(files[:-1])}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}


def test_pieces_of_a_long_record_are_joined(spark, tmp_path, monkeypatch):
    payload = b"".join(b"line %d\n" % i for i in range(50_000)) + b"e" * 2_000_000
    (tmp_path / "a.warc").write_bytes(record(b"first") + record(payload) + record(b"last"))
    monkeypatch.setattr(archives, "PIECE_BYTES", 50_000)
    split_every(spark, monkeypatch, 100_000)
    got = sorted(read_archives(spark, str(tmp_path)).collect())
    assert [bytes(r["payload"]) for r in got] == [b"first", payload, b"last"]


def brute(rows):
    out = []
    for page, _, html in rows:
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        data = (html or "").encode()
        last = max(same, default=None)
        copy = page is not None and page < last
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if copy else "response", last if copy else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip_equals_brute_force(spark, tmp_path, compression):
    html = ["<p>é</p>\r\n\r\n", "", None, "same", "same", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "same", "x" * 400_000, "퟿ \U0001f600\x00 nul", "tail\r\n"]
    rows = [(i, f"http://h/{i}", t) for i, t in enumerate(html)]
    rows += [(20, "http://h/a b\r\nWARC-Type: fake\r\n\r\n", "u"), (21, None, "same"), (21, None, "same"), (3, "x", "same"), (None, "y", "same"), (-7, "z", ""), (None, None, None)]
    rows += [(1000 + i, "copy", "a page that many others repeat") for i in range(300)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, identity string, size int")
    folder = str(tmp_path / "w")
    write_archives(archive_records(pages), folder, compression)
    got = described(read_archives(spark, folder)).collect()
    assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=str) == brute(rows)


def test_small_payloads_can_stay_whole(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    text = "".join(sorted(r["value"] for r in archive_records(pages, 3).collect()))
    assert text.count("revisit\r\n") == 1 and "WARC-Refers-To: <urn:page:4>" in text


def test_empty_table(spark, tmp_path):
    write_archives(archive_records(spark.createDataFrame([], "page_id long, url string, html string")), str(tmp_path / "w"))
    assert described(read_archives(spark, str(tmp_path / "w"))).count() == 0


def test_query_on_a_larger_table(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(connect(folder), op12_warc(spark, folder), OP12_SQL) is None
