import base64
import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from strata.llm import warc


def pages(spark):
    rng = random.Random(3)
    bodies = ["", None, "<p>é</p>", "x" * 100_000, "WARC/1.1\r\n\r\n a\r\n\r\n"] + [f"<b>{rng.random()}</b>" for _ in range(5)]
    rows = [(i, None if i % 7 == 0 else f"http://a.example/{i}?q=%0A\r\n", rng.choice(bodies)) for i in range(60)]
    rows += [rows[3], (None, None, "<p>é</p>"), (None, "u", "lone"), (None, "u", "lone")]
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, digest string, size int")


def want(rows, least):
    size = [len((h or "").encode()) for _, _, h in rows]
    key = [hashlib.sha1((h or "").encode()).digest() for _, _, h in rows]
    out = []
    for (i, u, h), n, k in zip(rows, size, key):
        top = max((r[0] for r, x in zip(rows, key) if x == k and r[0] is not None), default=None)
        revisit = n >= least and i != top
        out.append((i, n, base64.b32encode(k).decode(), "revisit" if revisit else "response", top if revisit else None, u,
                    None if revisit else h or ""))
    return out


def test_archives_return_every_record(spark):
    frame = pages(spark)
    rows = [(r.page_id, r.url, r.html) for r in frame.collect()]
    for least, size in ((0, 64 << 20), (5, 2000)):
        index = warc.write_archives(frame.repartition(3), warc.new_archive_folder(spark), min_bytes=least, archive_bytes=size)
        got = [tuple(r) for r in warc.read_records(index, most=500, gap=10).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want(rows, least)))
        some = index.filter("page_id % 5 = 0")  # a selection reads only its own records
        ids = sorted(r.page_id for r in warc.read_records(some, payloads=False).collect())
        assert ids == sorted(r[0] for r in rows if r[0] is not None and r[0] % 5 == 0)


def test_empty_table(spark):
    index = warc.write_archives(pages(spark).limit(0), warc.new_archive_folder(spark))
    assert index.count() == 0 and warc.read_records(index).count() == 0


def test_ranges_are_joined_and_bounded():
    import numpy as np

    offset, length = np.array([0, 10, 25, 100, 110]), np.array([10, 10, 5, 10, 500])
    assert list(warc._ranges(offset, length, 5, 60)) == [(0, 3), (3, 4), (4, 5)]
    assert list(warc._ranges(offset, length, 0, 1000)) == [(0, 2), (2, 3), (3, 5)]


@given(st.text(max_size=60), st.one_of(st.none(), st.text(max_size=20)), st.one_of(st.none(), st.integers(-5, 10 ** 12)))
def test_record_round_trip(payload, url, page):
    body = payload.encode("utf-8", "ignore")
    name = warc.base32_sha1(hashlib.sha1(body).digest())
    url = url if url is None else url.encode("utf-8", "ignore").decode()
    r = warc.parse_record(warc.record_bytes(page, url, body, len(body), name, None, False))
    assert (r["page_id"], r["url"], r["payload"].encode(), r["payload_digest"]) == (page, url, body, name)
    r = warc.parse_record(warc.record_bytes(page, url, b"", len(body), name, 9, True))
    assert (r["payload_bytes"], r["refers_to"], r["record_type"]) == (len(body), 9, "revisit")


def test_reading_is_cut_by_the_bytes_of_records(spark):
    """Many tasks for an index of few bytes; a payload of some megabytes among them."""
    import os

    from pyspark.sql import functions as F

    from strata.llm import warc
    pages = [(i, f"http://x/{i}", os.urandom(2000).hex()) for i in range(300)] + [(300, "http://x/long", os.urandom(2 << 20).hex())]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    index = warc.write_archives(frame, warc.new_archive_folder(spark))
    back = warc.read_records(index, task_bytes=100_000)
    assert back.rdd.getNumPartitions() > 10
    got = {r.page_id: r.payload for r in back.select("page_id", F.col("payload")).collect()}
    assert got == {i: h for i, _, h in pages}
