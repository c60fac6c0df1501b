from collections import defaultdict
from hashlib import sha256

import pytest

from hazardry.llm import warc as W

MAGIC = "WARC/1.1\r\n"


def nested(k):
    body = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\nfalse " + "z" * k
    return f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:99{k}>\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"


def pages():
    rows = [(k, f"http://h/{k}", f"<p>page {k}</p>" + "é" * (k * 13 % 200)) for k in range(60)]
    rows += [(100 + k, "http://copy", "<html>" + "copy " * 40) for k in range(25)]
    rows += [(200, "u", None), (201, None, ""), (202, "bad\r\nurl", "short"), (203, "u", "short"), (None, "n", "<html>" + "copy " * 40)]
    rows += [(300, "u", "before " + MAGIC + " after"), (301, "u", MAGIC), (302, "u", "a" + nested(5) + nested(70) + "b"), (303, "u", nested(5) * 30)]
    rows += [(304, "u", "x" * 50_000 + nested(9) + "y" * 50_000), (305, "u", "ends with\r\n\r\n"), (306, "u", "\r\n\r\nWARC/1.1"), (307, "u", MAGIC + "\r\n\r\n" + MAGIC)]
    rows += [(400, "u", "same id " * 30), (400, "u", "same id " * 30)]
    return rows


def expected(rows):
    copies = defaultdict(list)
    for page_id, _, html in rows:
        copies[html or ""].append(page_id)
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        ids = [i for i in copies[html or ""] if i is not None]
        first = min(ids) if len(body) >= 100 and len(copies[html or ""]) > 1 and ids else None
        revisit = first is not None and page_id != first
        out.append((page_id, len(body), sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as digest", "1 as payload").repartition(parts)


@pytest.fixture
def split_small(spark):
    """Archives are read in splits of a few hundred bytes, so records and version lines cross their ends."""
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    old = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("700", "1")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def round_trip(spark, rows, folder, payload):
    W.write_archives(frame(spark, rows), folder)
    return W.read_archives(spark, folder, payload)


@pytest.mark.parametrize("payload", [False, True])
@pytest.mark.parametrize("broadcast_rows", [0, W.MOST_BROADCAST_ROWS])
def test_round_trip(spark, tmp_path, monkeypatch, payload, broadcast_rows):
    monkeypatch.setattr(W, "MOST_BROADCAST_ROWS", broadcast_rows)
    got = W.page_records(round_trip(spark, pages(), f"{tmp_path}/w", payload)).collect()
    assert sorted(map(tuple, got), key=str) == expected(pages())


def test_round_trip_over_many_splits(spark, tmp_path, split_small):
    records = round_trip(spark, pages(), f"{tmp_path}/w", False)
    assert sorted(map(tuple, W.page_records(records).collect()), key=str) == expected(pages())
    assert not any(r["truncated"] for r in records.collect())
    assert W.candidates(spark, f"{tmp_path}/w").select("file", "split").distinct().count() > 60


def test_payloads_come_back(spark, tmp_path, split_small):
    rows = round_trip(spark, pages(), f"{tmp_path}/w", True).filter("record_type = 'response'").collect()
    got = {int(r["record_id"][10:-1] or -1): r["payload"] for r in rows}
    want = {p: (h or "").encode() for p, _, h in pages()}
    assert all(bytes(got[p]) == want[p] for p in got) and {300, 301, 302, 303, 304, 307} <= set(got)


def test_magic_in_payloads_is_a_candidate_and_is_rejected(spark, tmp_path):
    records = round_trip(spark, pages(), f"{tmp_path}/w", False)
    found = W.candidates(spark, f"{tmp_path}/w").filter("distance is not null").count()
    assert found > records.count() == len(pages())


def test_archive_is_standard(spark, tmp_path):
    """A plain reader that walks one file by its lengths finds every record."""
    W.write_archives(frame(spark, pages(), 1).coalesce(1), f"{tmp_path}/w")
    n = 0
    for file in tmp_path.glob("w/part-*"):
        data, at = file.read_bytes(), 0
        while at < len(data):
            head, _, _ = data[at:].partition(b"\r\n\r\n")
            assert head.startswith(MAGIC.encode())
            size = int(dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])[b"Content-Length"])
            at += len(head) + 4 + size
            assert data[at : at + 4] == b"\r\n\r\n"
            at, n = at + 4, n + 1
    assert n == len(pages())


def test_broken_chain_ends_its_file(spark, tmp_path):
    record = "{}WARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: {}\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabc\r\n\r\n"
    good = [record.format(MAGIC, k, 22) for k in range(6)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/whole.warc").write_bytes("".join(good).encode())
    (tmp_path / "in/broken.warc").write_bytes("".join([*good[:3], record.format(MAGIC, 7, 21), *good[3:]]).encode())
    (tmp_path / "in/cut.warc").write_bytes("".join(good).encode()[:-9])
    (tmp_path / "in/empty.warc").write_bytes(b"")
    rows = W.read_archives(spark, f"{tmp_path}/in", False).collect()
    ids = defaultdict(list)
    for r in rows:
        ids[r["file"].rsplit("/", 1)[1]].append((r["record_id"][10:-1], r["truncated"]))
    assert sorted(ids["whole.warc"]) == [(str(k), False) for k in range(6)]
    assert sorted(ids["broken.warc"]) == [("0", False), ("1", False), ("2", False), ("7", False)]
    assert sorted(ids["cut.warc"]) == [*((str(k), False) for k in range(5)), ("5", True)]


def test_no_pages(spark, tmp_path):
    assert round_trip(spark, [], f"{tmp_path}/w", False).count() == 0
