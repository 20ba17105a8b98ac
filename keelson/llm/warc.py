"""WARC archives and their merged capture index.

Writing. One record per page: ``response`` with the whole payload, or ``revisit`` of the
page with the smallest id that has the same payload (payloads of ``revisit_bytes`` bytes
or more). Records are written by Spark's own text writer, gzip per file, into the given folder
(commit protocol and retries as for any table): a record ends with CR LF CR LF, the last byte of
which is the writer's line end. Records are written by size classes, so that a file has at most
``RECORDS_PER_FILE`` records and ``ARCHIVE_BYTES`` bytes, or a single longer record.

Reading. Archives are loaded as whole files of that bounded size and cut by Content-Length,
so payloads may hold any text. Digests of responses are computed again from the payload.

Index. Each archive gives a capture run, sorted by (URL key, time, page) where it was read. The
runs are dealt by ranges of that order, each range gets its slices of the runs in run order and
merges them with a loser tree. The result names each capture's ``range`` and its ``place`` in
it: in the order of these two it is one sorted capture history (stored files are read in any
order). A URL with very many captures is split between ranges by its times and pages, a page
that is repeated very often by where its records stand.

Defined results: NULL payloads are empty; a NULL or empty URL has the empty URL key; line
breaks in URLs are percent-encoded; a NULL page id stays NULL and comes first; equal payloads of
one page (repeated rows) are all responses if that page has the smallest id. Without a date
column all captures are of ``FIRST_DATE`` and follow each other by page id, whatever 64-bit
number it is. Times are compared as numbers (years may have more than four digits). Extra
columns are ignored; an empty table gives an empty index. A record has to fit in memory.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import lookup, store

RECORDS_PER_FILE = 2_000
ARCHIVE_BYTES = 64 << 20
CAPTURES_PER_RANGE = 100_000
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: The date of captures without a timestamp column.
FIRST_DATE = "2024-01-01 00:00:00"
_RUN_SQL = ("url_key string, time long, page_id long, captured string, url string, "
            "record_type string, payload_digest string, payload_bytes long, refers_to long, "
            "run string, seq long, offset long, length long, intact boolean")
_INDEX_SQL = _RUN_SQL + ", range int, place long"
_COLUMNS = [c.split()[0] for c in _RUN_SQL.split(", ")]
_ORDER = ("url_key", "time", "page_id", "run", "seq")
_SEQ, _RUN = _COLUMNS.index("seq"), _COLUMNS.index("run")


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 payload_col: str = "html", date_col: str | None = None,
                 revisit_bytes: int = 100) -> DataFrame:
    """(page_id, url, payload, digest, bytes, date, refers_to): refers_to marks revisits."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    page = F.col(id_col).cast("long")
    date = F.col(date_col) if date_col else F.lit(FIRST_DATE).cast("timestamp_ntz")
    rows = pages.select(page.alias("page_id"), F.col(url_col).alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
                        F.octet_length(payload).cast("long").alias("bytes"),
                        F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"))
    firsts = store(rows.filter(F.col("bytes") >= revisit_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "payloads")
    return lookup(rows, firsts, "digest", "n", F.col("page_id")).select(
        "page_id", "url", "payload", "digest", "bytes", "date",
        F.when(F.col("page_id") > F.col("first"), F.col("first")).alias("refers_to"))


def _record() -> Column:
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(
        F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")),
                    F.lit("\n"), F.lit("%0A"))
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    length = F.octet_length(http) + F.when(again, F.lit(0)).otherwise(F.col("bytes"))
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    return F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", page("page_id")),
        line("WARC-Target-URI", url), line("WARC-Date", F.col("date")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, F.concat(line("WARC-Refers-To", page("refers_to")),
                               line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")), F.lit("\r\n"),
        http, F.when(again, "").otherwise(F.col("payload")), F.lit("\r\n\r"))


def write_archives(records: DataFrame, path: str, archive_bytes: int | None = None) -> None:
    """Write ``records`` (as ``plan_records`` gives them) class by class: a class holds records
    up to eight times as long as the class before, so an eighth as many fit in a file. Most
    corpora have one or two classes; each is a pass over the records."""
    limit = archive_bytes or ARCHIVE_BYTES
    first = max(1, limit // RECORDS_PER_FILE)
    # no less than the record: its header lines take less than 1 KB beside the URL
    size = (F.when(F.col("refers_to").isNull(), F.col("bytes")).otherwise(0)
            + 3 * F.coalesce(F.octet_length("url"), F.lit(0)) + 1024)
    of = F.greatest(F.lit(0), F.ceil(F.log2(size / first) / 3)).cast("int")
    found = sorted(x.c for x in records.select(of.alias("c")).distinct().collect())
    for c in found or [0]:
        (records.filter(of == c).select(_record().alias("value")).write.mode("append")
         .option("compression", "gzip")
         .option("maxRecordsPerFile", max(1, limit // (first * 8 ** c))).text(path))


def url_key(url: str) -> str:
    """Host labels from the top down, then the rest: sorts a site's captures together."""
    found = re.match(r"[^:/?#]*://([^/?#]*)(.*)", url, re.S)
    if not found:
        return url.lower()
    host, _, port = found[1].lower().partition(":")
    return ",".join(reversed(host.split("."))) + (":" + port if port else "") + ")" + found[2]


def _page(text: str | None) -> int | None:
    number = (text or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "null") else int(number)


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict, bytes, int, int]]:
    """(headers, block, offset, length) of every record; offsets count unpacked bytes."""
    offset = 0
    while line := stream.readline():
        if line != b"WARC/1.0\r\n":
            raise ValueError(f"no record at offset {offset}")
        headers, length = {}, len(line)
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name] = value
            length += len(line)
        block = stream.read(int(headers["Content-Length"]))
        length += 2 + len(block) + len(stream.read(4))
        yield headers, block, offset, length
        offset += length


def time_number(date: str) -> int:
    """A WARC date as a number in the order of time; the year may have any length."""
    year, rest = re.match(r"([+-]?\d+)-(.*)", date).groups()
    return int(year) * 10 ** 10 + int(re.sub(r"\D", "", rest)[:10].ljust(10, "0"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted capture run per archive."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = []
            with gzip.GzipFile(fileobj=io.BytesIO(content.as_py())) as stream:
                for headers, block, offset, length in read_records(stream):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    revisit = headers["WARC-Type"] == "revisit"
                    actual = digest if revisit else hashlib.sha256(payload).hexdigest()
                    url = headers["WARC-Target-URI"]
                    rows.append((url_key(url), time_number(headers["WARC-Date"]),
                                 _page(headers["WARC-Record-ID"]), headers["WARC-Date"],
                                 url, headers["WARC-Type"], actual,
                                 size if revisit else len(payload),
                                 _page(headers.get("WARC-Refers-To")), path.rpartition("/")[2], 0,
                                 offset, length, actual == digest and (revisit or size == len(payload))))
            rows.sort(key=_key)
            rows = [(*r[:_SEQ], k, *r[_SEQ + 1:]) for k, r in enumerate(rows)]
            if rows:
                yield _batch(rows, _COLUMNS)


def _key(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0


class LoserTree:
    """Merges sorted sequences, ties in the order of the sequences: each inner node remembers the loser of its match, so taking
    the smallest head costs one match per level."""

    def __init__(self, runs: list[list[tuple]]):
        self.sources = [iter(r) for r in runs]
        self.heads = [next(s, None) for s in self.sources]
        self.size = len(runs)
        self.losers = [-1] * self.size
        self.winner = self._play(1) if self.size else -1

    def _beats(self, a: int, b: int) -> bool:
        """Ended runs lose to all; ties go to the earlier run."""
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and (self.heads[a] is not None or a < b)
        x, y = _key(self.heads[a]), _key(self.heads[b])
        return x < y or (x == y and a < b)

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return winner

    def __iter__(self) -> Iterator[tuple]:
        while self.size and (row := self.heads[self.winner]) is not None:
            yield row
            self.heads[self.winner] = next(self.sources[self.winner], None)
            node = (self.winner + self.size) // 2
            while node:
                if self._beats(self.losers[node], self.winner):
                    self.losers[node], self.winner = self.winner, self.losers[node]
                node //= 2


def _batch(rows: list[tuple], columns: list[str]) -> pa.RecordBatch:
    longs = ("time", "page_id", "refers_to")
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) if n in longs else pa.array(c)
         for n, c in zip(columns, map(list, zip(*rows)))], columns)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge one range's slices of the runs (bounded by the size of a range), which come one
    after the other, each in its order."""
    runs: list[list[tuple]] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if not runs or runs[-1][-1][_RUN] != row[_RUN]:
                runs.append([])
            runs[-1].append(row)
    merged = list(LoserTree(runs))
    if merged:
        number = pa.array([TaskContext.get().partitionId()] * len(merged), pa.int32())
        out = _batch(merged, _COLUMNS)
        yield pa.RecordBatch.from_arrays(
            [*out.columns, number, pa.array(range(len(merged)))], [*_COLUMNS, "range", "place"])


def capture_history(spark: SparkSession, path: str, per_range: int | None = None) -> DataFrame:
    """The merged index of the archives under ``path``: in the order of ``range`` and ``place``
    it runs by (url_key, time, page)."""
    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    runs = store(archives.mapInArrow(_runs, _RUN_SQL), "capture_runs")
    ranges = max(1, runs.count() // (per_range or CAPTURES_PER_RANGE) + 1)
    dealt = runs.repartitionByRange(ranges, *_ORDER).sortWithinPartitions("run", "seq")
    return store(dealt.mapInArrow(_merge, _INDEX_SQL), "captures")
