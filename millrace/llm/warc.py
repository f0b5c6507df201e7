"""WARC archives: written as locally sorted capture runs, indexed by an external merge.

Writing: each task sorts its pages by URL key and time and writes them as runs, gzipped WARC
files of a bounded number of records, through Spark's text sink (a record ends in an empty
line, which is the sink's line separator). Only the page with the smallest id of those with equal payloads carries
the payload; the others revisit it.

Reading: the files are read whole (they are bounded) and parsed by their Content-Length as a
stream. Every run gives sorted index entries. These are cut into ranges of (URL key, time, id);
the task of a range merges the slices of its runs with a loser tree, so the ranges one after the other
are the globally ordered capture histories.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import wide_join
from millrace.operators import lookup_join
from millrace.sources import materialise

#: Records in a run at most.
RUN_RECORDS = 5_000
#: Index entries that one merging task holds, on average.
MERGE_ENTRIES = 200_000
#: Capture time of page 0; page n is captured n seconds later, modulo a hundred years.
EPOCH = 1_700_000_000
CENTURY = 36_525 * 86_400

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CRLF = "\r\n"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: eight groups of 20 bits, four letters each."""
    digest = F.sha1(data)
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(_ALPHABET), F.shiftright(bits, shift) % 32 + 1, F.lit(1)))
    return F.concat(*letters)


def url_key(url: Column) -> Column:
    """Sort key of an URL: host labels from the right, then path and query; lower case.

    User, port, scheme, fragment and a leading ``www`` do not count. What is no URL is its own key.
    """
    whole = F.lower(F.coalesce(url, F.lit("")))
    pattern = r"^[a-z][a-z0-9+.-]*://([^/?#@]*@)?(www\.)?([^/?#:]+)(:[0-9]*)?([^#]*)"
    host = F.regexp_extract(whole, pattern, 3)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), ","), F.lit(")"), F.regexp_extract(whole, pattern, 5))
    return F.when(host == "", whole).otherwise(key)


def _captured(page_id: Column) -> Column:
    """The capture time in UTC, worked out from numbers so that no session time zone matters."""
    seconds = F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(CENTURY)) + EPOCH
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86_400).cast("int"))
    rest = seconds % 86_400

    def two(n: Column) -> Column:
        return F.lpad(F.floor(n).cast("string"), 2, "0")

    clock = F.concat_ws(":", two(rest / 3600), two(rest % 3600 / 60), two(rest % 60))
    return F.concat(day.cast("string"), F.lit("T"), clock, F.lit("Z"))


def _revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, digest, refers_to of the pages whose payload another page carries."""
    narrow = pages.select("page_id", "digest", "size").where(F.col("size") >= least_bytes)
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    first = materialise(first.where("n > 1").drop("n"))
    found = lookup_join(narrow.select("page_id", "digest"), first, ["digest"])
    return materialise(found.where("NOT page_id <=> refers_to").distinct())


def write_archives(
    pages: DataFrame, path: str, least_bytes: int = 0, run_records: int = RUN_RECORDS
) -> None:
    """Write pages (page_id, url, html) as WARC runs under ``path``.

    A null html is an empty payload. Line ends inside an URL are percent-encoded. Of pages with equal payloads of at least
    ``least_bytes`` the one with the smallest id is a response (rows that repeat it too), and the others,
    those without an id as well, revisit it; without any id all are responses.
    """
    html = F.coalesce("html", F.lit(""))
    prepared = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        html.alias("html"), F.octet_length(html).alias("size"),
        F.sha1(html).alias("digest"), base32_sha1(html).alias("digest32"),
    )
    rows = wide_join(prepared, _revisits(prepared, least_bytes), ["page_id", "digest"], "left")
    revisit = F.col("refers_to").isNotNull()
    line = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        F.col("size").cast("string"), F.lit(_CRLF * 2),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))

    def name(page_id: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))

    def header(key: str, value: Column) -> Column:
        return F.concat(F.lit(f"{key}: "), value, F.lit(_CRLF))

    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    record = F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", name(F.col("page_id"))),
        header("WARC-Date", F.col("captured")),
        header("WARC-Target-URI", line),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest32"))),
        F.when(
            revisit, F.concat(header("WARC-Refers-To", name(F.col("refers_to"))), header("WARC-Profile", profile))
        ).otherwise(""),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_CRLF), block,
    )
    keyed = rows.withColumn("captured", _captured(F.col("page_id"))).withColumn("key", url_key(F.col("url")))
    run = keyed.sortWithinPartitions("key", "captured", "page_id").select(record.alias("value"))
    writer = run.write.option("maxRecordsPerFile", run_records).option("lineSep", _CRLF * 2)
    writer.option("compression", "gzip").text(path)


_NUMBER = re.compile(r"<urn:page:(-?\d+)>")


def parse_archive(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of one archive, headers and payload figures, one at a time."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline().decode().rstrip(_CRLF)):
            key, _, value = line.partition(": ")
            headers[key.lower()] = value
        block = stream.read(int(headers["content-length"]))
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        kind = headers["warc-type"]
        if kind == "response":
            actual = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if (len(payload), actual) != (size, digest):
                raise ValueError(f"the payload of {headers['warc-record-id']} is damaged")
        ids = [_NUMBER.match(headers.get(k, "")) for k in ("warc-record-id", "warc-refers-to")]
        page_id, refers_to = (int(m[1]) if m else None for m in ids)
        yield {
            "url": headers["warc-target-uri"], "captured": headers["warc-date"], "page_id": page_id,
            "record_type": kind, "payload_bytes": size, "payload_digest": digest, "refers_to": refers_to,
        }


_ENTRY = (
    "run string, url string, captured string, page_id long, record_type string, "
    "payload_bytes long, payload_digest string, refers_to long"
)
_FIELDS = pa.schema(
    [(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in _ENTRY.split(", ")]
)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all records of all archives, one run per file; payloads are checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                name, rows = name.as_py(), []
                with gzip.open(io.BytesIO(content.as_py())) as stream:
                    for record in parse_archive(stream):
                        rows.append(record | {"run": name})
                        if len(rows) == 1000:
                            yield pa.RecordBatch.from_pylist(rows, _FIELDS)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, _FIELDS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(run, _ENTRY)


class LoserTree:
    """k-way merge of sorted lists: each inner node keeps the loser of its match, the winner goes on."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(runs))
        self.heads = [next(r, None) for r in self.runs] or [None]
        self.losers = [0] * self.k
        winners = [0] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            a, b = (a, b) if self._before(a, b) else (b, a)
            winners[node], self.losers[node] = a, b
        self.winner = winners[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's head comes first; a run at its end comes last, ties by run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[self.winner]) is not None:
            yield head
            w = self.winner
            self.heads[w] = next(self.runs[w], None)
            node = (w + self.k) // 2
            while node:
                if self._before(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def merge_index(entries: DataFrame, merge_entries: int = MERGE_ENTRIES) -> DataFrame:
    """The entries in the order of (key, captured, page_id; nulls first) with their position from 0.

    ``entries``: run, key, captured, page_id and more, written. A range is bounded by the whole order, so the captures of
    one URL may span many tasks.
    """
    ranges = entries.count() // merge_entries + 1
    order, names = ["key", "captured", "page_id"], entries.columns
    ranged = entries.repartitionByRange(ranges, *order).sortWithinPartitions("run", *order)
    ranged = ranged.withColumn("_range", F.spark_partition_id()).withColumn("_local", F.lit(0).cast("long"))
    at = [names.index(c) for c in order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                key = tuple((row[i] is not None, row[i]) if row[i] is not None else (False,) for i in at)
                runs.setdefault(row[names.index("run")], []).append((key, len(runs), row))
        rows: list[tuple] = []
        for n, (_, _, row) in enumerate(LoserTree(list(runs.values()))):
            rows.append((*row[:-1], n))
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    merged = materialise(ranged.mapInArrow(run, ranged.schema))
    counts = sorted(tuple(r) for r in merged.groupBy("_range").count().collect())
    starts = list(zip([r for r, _ in counts], accumulate([0, *[n for _, n in counts]])))
    shifts = entries.sparkSession.createDataFrame(starts, "_range int, _start long")
    placed = merged.join(F.broadcast(shifts), "_range")
    return placed.select(*names, (F.col("_local") + F.col("_start")).alias("position"))


def capture_index(spark: SparkSession, path: str, merge_entries: int = MERGE_ENTRIES) -> DataFrame:
    """The globally ordered capture histories of the archives under ``path``.

    run, url, captured, page_id, record_type, payload_bytes, payload_digest, refers_to, key, position.
    """
    entries = read_runs(spark, path).withColumn("key", url_key(F.col("url")))
    return merge_index(materialise(entries), merge_entries)
