"""Archives round trip, the merge against sorting, and edge rows."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm.warc import LoserTree, base32_sha1, capture_index, url_key, write_archives
from tests.helpers import rows


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    for _ in range(30):
        runs = [sorted((rng.randrange(30), i) for _ in range(rng.randrange(0, 12))) for i in range(k)]
        assert list(LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_url_keys(spark):
    urls = {
        "https://WWW.Example.com/A?b=1#frag": "com,example)/a?b=1", "http://user:pw@m.example.co.uk:8080": "uk,co,example,m)",
        "not an url": "not an url", "": "", None: "", "https://example.com": "com,example)",
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string").select("url", url_key(F.col("url")).alias("key"))
    assert {r["url"]: r["key"] for r in df.collect()} == urls


def expected(pages):
    first = {}
    for page_id, _, html in pages:
        ids = first.setdefault(html or "", [])
        if page_id is not None:
            ids.append(page_id)
    out = []
    for page_id, url, html in pages:
        payload, ids = (html or "").encode(), first[html or ""]
        head = min(ids, default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = "response" if page_id == head else "revisit"
        out.append((page_id, len(payload), digest, kind, None if kind == "response" else head))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_path):
    rng = random.Random(3)
    trap = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    bodies = ["", "<p>é</p>", trap, "\r\n\r\n", "x" * 300_000, "same", "a\nb", None]
    pages = [(i, f"http://h{rng.randrange(6)}.example.com/{rng.randrange(3)}", rng.choice(bodies)) for i in range(300)]
    pages += [(2**62, "http://z.example.com/", "late"), (-5, "http://z.example.com/", "early"), (400, None, "same"), (401, "http://a.b/\r\nX: y", "one"), (None, "http://a.b/", "same"), (5, pages[5][1], pages[5][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("size", F.lit("clash"))
    path = str(tmp_path / "warc")
    write_archives(df.repartition(5), path, run_records=17)
    index = capture_index(spark, path, merge_entries=50)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows(index, *columns) == expected(pages)
    found = sorted(index.collect(), key=lambda r: r["position"])
    assert [r["position"] for r in found] == list(range(len(pages)))
    keys = [(r["key"], r["captured"], r["page_id"] is not None, r["page_id"]) for r in found]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1], k[2], k[3] or 0))
    assert len({r["run"] for r in found}) > 10
    times = {r["page_id"]: r["captured"] for r in found}
    assert times[0] == times[None] == "2023-11-14T22:13:20Z" and times[299] == "2023-11-14T22:18:19Z"
    assert {r["url"] for r in found if r["page_id"] == 401} == {"http://a.b/%0D%0AX: y"}


def test_small_payloads_are_not_revisited(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "aaaa"), (4, "u", "aaaa")], "page_id long, url string, html string")
    write_archives(df, str(tmp_path / "w"), least_bytes=3)
    kinds = rows(capture_index(spark, str(tmp_path / "w")), "page_id", "record_type")
    assert kinds == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_no_pages(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    write_archives(df, str(tmp_path / "w"))
    assert capture_index(spark, str(tmp_path / "w")).collect() == []


def test_digest(spark):
    texts = ["", "a", "é" * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", base32_sha1(F.col("t")).alias("d"))
    assert {r["t"]: r["d"] for r in df.collect()} == {t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in texts}
