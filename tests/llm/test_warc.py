import hashlib
import struct

import pytest

from kerbflow.llm import warc as W


def test_archive_round_trip_with_dictionary():
    records = [W.record_bytes(i, f"http://x/{i}", b"<html>" + b"abc %d" % i * 300, None, "d") for i in range(200)]
    data = b"".join(W.archive_bytes(records, 3, 4096, 1 << 20))
    assert struct.unpack_from("<I", data)[0] == W.DICT_MAGIC
    assert list(W.archive_records(data, step=1000)) == records
    few = b"".join(W.archive_bytes(records[:2], 3, 4096, 1 << 20))
    assert list(W.archive_records(few)) == records[:2]
    assert list(W.archive_records(b"")) == []


def test_reader_rejects_damage():
    good = W.record_bytes(7, "u", b"payload", None, "d")
    assert W.parse_record(good)[0] == 7
    revisit = W.record_bytes(6, None, b"payload", 7, "d")
    assert W.parse_record(revisit)[2:6] == (7, hashlib.sha1(b"payload").hexdigest(), "revisit", 7)
    for bad in (good[:-1], good.replace(b"payload", b"paylaod"), good.replace(b"WARC/1.1", b"WARG/1.1"),
                good.replace(b"WARC-Type: response\r\n", b""), good.replace(b"WARC-Date: d", b"WARC-Date d")):
        with pytest.raises(W.BadArchive):
            W.parse_record(bad)
    data = b"".join(W.archive_bytes([good] * 3, 3, 4096, 1 << 20))
    for cut in (data[:-3], data[:5], data + b"junk"):
        with pytest.raises(W.BadArchive):
            list(W.archive_records(cut))


def test_pages_to_archives_and_back(spark):
    big, other = "é" * 600, "b" * 2000
    rows = [(1, "http://a/ \r\nx", big, "c"), (5, "http://b/ü", big, "c"), (3, None, big, "c"), (2, "u", "tiny", "c"), (4, "u", "tiny", "c"),
            (6, "u", None, "c"), (7, "u", "", "c"), (8, "u", other, "c"), (8, "u", other, "c"), (9, "u", "z" * 999, "c"), (10, "u", "z" * 999, "c"),
            (None, "u", big, "c"), (11, "u", "y" * 300_000, "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    got = W.warc_query(spark, pages).collect()
    want = []
    for p, _, h, _ in rows:
        raw = (h or "").encode()
        last = max((q for q, _, g, _ in rows if g == h and q is not None), default=None) if len(raw) >= 1000 else None
        again = last is not None and p is not None and p < last
        want.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", last if again else None))
    key = lambda r: tuple(str(x) for x in r)           # noqa: E731
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    full = W.read_archives(W.write_archives(spark, W.with_revisits(pages), archive_size=3000)).collect()
    assert {(r.page_id, bytes(r.payload)) for r in full if r.record_type == "response"} >= {(6, b""), (5, big.encode())}
    assert W.warc_query(spark, pages.limit(0)).count() == 0
