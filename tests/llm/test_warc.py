import gzip
import hashlib
import random

from tallyspark.llm import warc
from tallyspark.session import scratch_path


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS digest", "1 AS payload", "'t' AS refers_to")



def test_pages_round_trip(spark):
    big, rng = "p" * 1000, random.Random(2)
    noise = "".join(chr(rng.randint(32, 0x24F)) for _ in range(300_000))
    rows = [(1, "http://a", big), (2, "http://b", big), (3, None, "p" * 999), (4, "u\r\nInjected: x", "p" * 999), (5, "", None), (6, "e", ""),
            (7, "n", noise), (8, "n", noise), (9, "r", big + "é"), (9, "r", big + "é"), (None, "q", big)]
    path = scratch_path(spark, "warc")
    warc.archive_pages(_pages(spark, rows), path)
    got = sorted(map(tuple, warc.pages_from(spark, path).collect()), key=str)
    best = {big: 2, noise: 8, big + "é": 9}
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = i is not None and h in best and i < best[h]
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", best[h] if again else None))
    assert got == sorted(want, key=str)
    empty = scratch_path(spark, "warc")
    warc.archive_pages(_pages(spark, []), empty)
    assert warc.pages_from(spark, empty).count() == 0


def test_any_byte_range_and_broken_bytes(spark, tmp_path):
    rng = random.Random(3)
    payloads = [bytes(rng.randrange(256) for _ in range(rng.randint(0, 3000))) + warc.MAGIC * 3 for _ in range(60)]
    data = b""
    for i, p in enumerate(payloads):
        member = warc._member(warc.record(f"urn:{i}", "u", p, hashlib.sha1(p).hexdigest(), None, "2026-01-01T00:00:00Z"))
        data += (b"junk" + warc.MAGIC + b"more junk" if i % 7 == 3 else b"") + member + (gzip.compress(b"") if i % 5 == 0 else b"")
    (tmp_path / "x.warc.gz").write_bytes(data)
    uri = (tmp_path / "x.warc.gz").as_uri()
    for size in (257, 5000, 1 << 20):
        found = [r for lo in range(0, len(data), size) for r in warc.records(uri, lo, min(lo + size, len(data)))]
        assert [h["warc-record-id"] for _, h, _ in found] == [f"<urn:{i}>" for i in range(60)]
        assert [b.partition(b"\r\n\r\n")[2] for _, _, b in found] == payloads
    rows = warc.read(spark, str(tmp_path), 4096).orderBy("offset").collect()
    assert [bytes(r.payload) for r in rows] == payloads and rows[0].payload_digest == hashlib.sha1(payloads[0]).hexdigest()


def test_long_record_ends_like_the_others():
    member = warc._member(b"\x00" * (17 << 20))
    assert member.endswith(warc.END) and gzip.decompress(member) == b"\x00" * (17 << 20)
