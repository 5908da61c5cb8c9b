"""WARC: round trip through files, and salvage after damage."""

import hashlib
import random

from roadpulse.llm import warc
from roadpulse.session import scratch_path


def records(n, size=1500):
    draw = random.Random(7)
    for i in range(n):
        payload = bytes(draw.randrange(256) for _ in range(size + i))
        yield i, payload, warc.record_bytes(i, f"http://x/{i}", payload, hashlib.sha1(payload).hexdigest(), None)


def test_round_trip(spark, none):
    big = "é" * 3000
    pages = [(1, "u", big), (5, None, big), (3, "u\r\nX: y", big), (7, "v", None), (8, "v", ""), (9, "w", "small"), (10, "w", "small"), (None, "n", "z" * 2000)]
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    found = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    assert len(found) == len(pages) and found[5].kind == "response" and found[5].payload.decode() == big
    for i, _, html in pages:
        data = (html or "").encode()
        assert found[i].payload_bytes == len(data) and found[i].payload_digest == hashlib.sha1(data).hexdigest()
    assert {i for i, r in found.items() if r.kind == "revisit"} == {1, 3} and found[1].refers_to == 5
    assert warc.gaps(warc.read_archives(spark, path)).count() == 0
    nothing = scratch_path(spark, "warc-none")
    warc.write_archives(none.selectExpr("doc_id AS page_id", "text AS url", "text AS html"), nothing)
    assert warc.read_archives(spark, nothing).count() == 0


def test_archives_are_bounded(spark, monkeypatch):
    """Large payloads have archives of their own, copies among them too; small ones share archives of a few records."""
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 4)
    monkeypatch.setattr(warc, "LARGE_BYTES", 5000)
    pages = [(i, "u", "x" * (6000 if i % 5 == 0 else 1000 + i)) for i in range(30)]
    path = scratch_path(spark, "warc-bound")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), path)
    found = warc.read_archives(spark, path).collect()
    assert sorted(r.page_id for r in found) == list(range(30)) and {r.page_id for r in found if r.kind == "revisit"} == {0, 5, 10, 15, 20}
    held = {}
    for r in found:
        held.setdefault(r.file, []).append(r.payload_bytes)
    assert all(len(sizes) <= (1 if "/large/" in file else 4) for file, sizes in held.items())
    assert all((n >= 5000) == ("/large/" in file) for file, sizes in held.items() for n in sizes)


def test_null_page_ids(spark):
    """A null page_id revisits the known one; without a known one nothing can be referred to. Clashing names are not read."""
    rows = [(1, "x" * 1200, 1), (None, "x" * 1200, 2), (None, "y" * 1200, 3), (None, "y" * 1200, 4), (2, "s", 5), (None, "s", 6)]
    pages = spark.createDataFrame(rows, "page_id long, html string, strong int").selectExpr("*", "'u' AS url", "1 AS last")
    found = {(r.page_id, r.html[0], r.refers_to) for r in warc.marked_pages(pages).collect()}
    assert found == {(1, "x", None), (None, "x", 1), (None, "y", None), (2, "s", None), (None, "s", None)}


def test_members_end_in_zero_and_unzip():
    import gzip

    for data in (b"", b"a" * 17_000_000):
        out = warc.member(data)
        assert out[-1] == 0 and gzip.decompress(out) == data


def test_salvage_members():
    made = list(records(6))
    data = bytearray()
    starts = []
    for _, _, r in made:
        starts.append(len(data))
        data += warc.member(r)
    data[starts[2] + 60] ^= 0xFF  # a broken member
    cut = bytes(data[: starts[5] + 40])  # and a truncated last one
    found = list(warc.salvage(b"junk" + cut))
    good = [r["page_id"] for _, _, r in found if isinstance(r, dict)]
    assert good == [0, 1, 3, 4]
    lost = [(s, e) for s, e, r in found if isinstance(r, str)]
    assert lost == [(0, 4), (starts[2] + 4, starts[3] + 4), (starts[5] + 4, len(cut) + 4)]


def test_salvage_plain_records():
    made = list(records(5))
    parts = [r for _, _, r in made]
    parts[1] = parts[1].replace(b"Content-Length: ", b"Content-Length: 9", 1)  # a wrong length
    payload = made[3][1]
    parts[3] = parts[3].replace(payload, payload[:-1] + bytes([payload[-1] ^ 1]))  # a wrong digest
    found = list(warc.salvage(b"".join(parts)))
    assert [r["page_id"] for _, _, r in found if isinstance(r, dict)] == [0, 2, 4]
    assert sum(e - s for s, e, r in found if isinstance(r, str)) == len(parts[1]) + len(parts[3])
    assert found[0][0] == 0 and found[-1][1] == sum(map(len, parts))


def test_payload_that_looks_like_a_record():
    inner = next(records(1))[2]
    outer = warc.record_bytes(9, "u", inner, hashlib.sha1(inner).hexdigest(), None)
    found = list(warc.salvage(outer))
    assert len(found) == 1 and found[0][2]["payload"] == inner
