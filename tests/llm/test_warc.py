"""Round trip through monolithic and normalised archives."""

import gzip
import hashlib
import os
import random

from cohortlake.llm import warc
from cohortlake.llm.common import Scratch


def test_round_trip_offsets_and_revisits(spark):
    rng = random.Random(1)
    bodies = ["a" * 1200, "b" * 999, "é" * 500, None, "", "\r\n\r\n" * 400, "WARC/1.1\r\n" * 200]
    rows = [(i, f"http://x/{i}\r\né" if i % 3 else None, rng.choice([*bodies, "c" * 5000 + str(i)])) for i in range(300)]
    rows.append((1000, "http://long", "long text " * 300_000))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    index, folder = warc.archive(pages, Scratch(spark, "test"))
    got = {r.page_id: r for r in warc.read_back(index, folder).collect()}
    top = {}
    for i, _, html in rows:
        top[html or ""] = max(top.get(html or "", -1), i)
    assert len(got) == len(rows)
    for i, _, html in rows:
        payload, g = (html or "").encode(), got[i]
        again = len(payload) >= 1000 and top[html or ""] != i
        assert (g.payload_bytes, g.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert (g.record_type, g.refers_to) == (("revisit", top[html or ""]) if again else ("response", None))
    # both forms inflate as plain gzip files; the sidecar's offsets are those of the members
    local = folder.removeprefix("file://")
    names = sorted(os.listdir(local))
    whole = [n for n in names if n.endswith(".records.warc.gz")]
    assert len(whole) * 3 == len(names) and not [n for n in names if n.endswith(".part")]
    for name in whole:
        data = open(f"{local}/{name}", "rb").read()
        assert gzip.decompress(data).count(b"WARC-Type: ") >= gzip.decompress(data).count(b"\r\nX-Payload-Length: ")
        for line in open(f"{local}/{name.removesuffix('warc.gz')}idx"):
            _, offset, length, _ = line.rstrip("\n").split("\t")
            assert gzip.decompress(data[int(offset) : int(offset) + int(length)]).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_null_and_repeated_page_ids(spark):
    body = "z" * 2000
    pages = spark.createDataFrame([(None, "u", body), (5, "u", body), (5, "u", body), (None, None, None)], "page_id long, url string, html string").coalesce(1)
    index, folder = warc.archive(pages, Scratch(spark, "test"))
    out = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.read_back(index, folder).collect()), key=repr)
    assert out == sorted([(5, "response", None), (5, "revisit", 5), (None, "revisit", 5), (None, "response", None)], key=repr)


def test_repeated_tasks_write_equal_files(spark):
    pages = spark.createDataFrame([(i, f"u{i}", "text " * i) for i in range(50)], "page_id long, url string, html string").coalesce(1)
    scratch = Scratch(spark, "test")
    digests = []
    for _ in range(2):
        _, folder = warc.archive(pages, scratch)
        local = folder.removeprefix("file://")
        digests.append({n: hashlib.sha1(open(f"{local}/{n}", "rb").read()).hexdigest() for n in os.listdir(local)})
    assert digests[0] == digests[1]
