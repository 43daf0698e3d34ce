"""WARC archives: writing with revisit records, reading back, and a globally ordered capture index.

*Writing.*  Each page is a record of a WARC 1.1 file: a ``response`` with an HTTP head and the payload, or a ``revisit``
with the head alone that refers to the response of the same payload.  Of equal payloads of ``least_bytes`` or more the one
with the largest page_id is the response.  Digests are grouped with a partial maximum before the shuffle and come back to
the pages by (page_id, digest), so a payload that a third of all pages share is no hot key where payloads are moved.
Spark's text writer makes the files: a record ends with two line breaks, which is its line separator; gzip makes a file
one stream, which one task reads in order.  So any store that Spark writes to will do.

*Reading* takes the stream apart by the records' Content-Length, record by record, whatever the payload holds.

*Index.*  A reader task sorts its captures in runs of ``RUN`` entries by URL key (reversed host, path, query) and time.
Runs are dealt by key range; in each range a loser tree merges the pieces of all runs, so that the ranges, one after
another, are the ordered capture history.  A range has ``RANGE`` entries at most on average; equal keys may lie in two ranges.

Defined cases: null html is an empty payload; a null url is written as ``urn:page:<id>``; line breaks in a url are
escaped; a null page_id stays null and equal payloads of such pages are responses; rows that repeat a page_id each are a
record (with the largest id they are all responses); further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, shuffle_width, small_batches, written

BREAK = "\r\n\r\n"
LEAST_BYTES, RUN, RANGE = 1000, 50_000, 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = "url_key string, captured_at string, page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def capture_time(page_id: Column) -> Column:
    """A time for pages that have none: that many seconds after the start of 2020, within 2**30 seconds."""
    at = F.timestamp_seconds(F.lit(1_577_836_800) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1 << 30)))
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def write_archives(pages: DataFrame, path: str, captured_at: Column | None = None, least_bytes: int = LEAST_BYTES) -> None:
    html = F.coalesce("html", F.lit(""))
    own = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("size"),
        (capture_time(F.col("page_id")) if captured_at is None else captured_at).alias("at"),
    )
    large = own.select("page_id", "digest", "size").where(F.col("size") >= least_bytes)
    leaders = large.groupBy("digest").agg(F.max("page_id").alias("leader"), F.count("*").alias("c")).where("c > 1").drop("c")
    repeats = large.select("page_id", "digest").join(leaders, "digest").where("page_id < leader").distinct()
    joined = own.join(repeats, ["page_id", "digest"], "left")
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    uri = F.coalesce(F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.concat(F.lit("urn:page:"), name))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(BREAK))
    block = F.concat(head, F.when(F.col("leader").isNull(), F.col("html")).otherwise(""))
    fields = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(F.col("leader").isNull(), "response").otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"),
        name,
        F.lit(">\r\nWARC-Target-URI: "),
        uri,
        F.lit("\r\nWARC-Date: "),
        F.col("at"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.coalesce(F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("leader").cast("string"), F.lit(">")), F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(BREAK),
        F.col("block"),
    )
    joined.withColumn("block", block).select(fields.alias("value")).write.option("lineSep", BREAK).option("compression", "gzip").text(path)


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(fields, block) of each record of a stream that was cut at each BREAK; only one record is held at a time."""
    mark, held, need, head = BREAK.encode(), bytearray(), 0, None
    for chunk in chunks:
        held += chunk
        held += mark
        while True:
            if head is None:
                start = len(held) - len(held.lstrip(b"\r\n"))
                end = held.find(mark, start)
                if end < 0:
                    break
                lines = bytes(held[start:end]).split(b"\r\n")
                if not lines[0].startswith(b"WARC/"):
                    raise ValueError(f"no WARC record starts with {lines[0][:40]!r}")
                head = dict(line.split(b": ", 1) for line in lines[1:])
                del held[: end + len(mark)]
                need = int(head[b"Content-Length"])
            if len(held) < need:
                break
            yield head, bytes(held[:need])
            del held[:need]
            head = None
    if head is not None:
        raise ValueError("the archive ends within a record")


def url_key(url: str) -> str:
    """``com,example,www)/path?query`` of a url, lower-cased; urls without a host are their own key."""
    scheme, mark, rest = url.partition("://")
    if not mark:
        return url.lower()
    rest = rest.partition("#")[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, path = rest[:cut], rest[cut:] or "/"
    return (",".join(reversed(host.split("."))) + ")" + path).lower()


def _number(name: bytes) -> int | None:
    text = name.strip(b"<>").removeprefix(b"urn:page:")
    return None if text == b"null" else int(text)


def entry(head: dict[bytes, bytes], block: bytes) -> tuple:
    url, kind = head[b"WARC-Target-URI"].decode(), head[b"WARC-Type"].decode()
    http, _, payload = block.partition(BREAK.encode())
    if kind == "response":
        size, digest, refers = len(payload), hashlib.sha1(payload).hexdigest(), None
        if head[b"WARC-Payload-Digest"] != b"sha1:" + digest.encode():
            raise ValueError(f"the payload of {url} is not what was written")
    else:
        size = int(http.rpartition(b"Content-Length: ")[2])
        digest, refers = head[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"), _number(head[b"WARC-Refers-To"])
    return url_key(url), head[b"WARC-Date"].decode(), _number(head[b"WARC-Record-ID"]), url, size, digest, kind, refers


_NAMES = [x.split()[0] for x in ENTRY.split(", ")]
_TYPES = [pa.string() if x.endswith("string") else pa.int64() for x in ENTRY.split(", ")]


def _order(e: tuple) -> tuple:
    return e[0], e[1], e[2] is not None, e[2] or 0


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of the archives of a task in sorted runs: run, then the columns of an entry."""
    base, n, held = TaskContext.get().partitionId() << 32, 0, []

    def batch() -> pa.RecordBatch:
        held.sort(key=_order)
        columns = [pa.array(c, t) for c, t in zip(zip(*held), _TYPES)]
        return pa.RecordBatch.from_arrays([pa.array([base + n] * len(held), pa.int64()), pa.array(range(len(held)), pa.int64()), *columns], names=["run", "seq", *_NAMES])

    chunks = (x.as_buffer().to_pybytes() for b in batches for x in b.column("value").cast(pa.binary()))
    for head, block in records(chunks):
        held.append(entry(head, block))
        if len(held) == RUN:
            yield batch()
            n, held = n + 1, []
    if held:
        yield batch()


class LoserTree:
    """Merges k sorted iterators: inner nodes keep the losers of their matches, the winner of all is taken next."""

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.keys = [None if h is None else key(h) for h in self.heads]
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        return y is None or x is not None and (x, a) < (y, b)

    def _play(self, i: int) -> None:
        node = (i + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # the first to come waits here for its match
                self.losers[node] = i
                return
            if self._before(other, i):
                self.losers[node], i = i, other
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator:
        while self.k and self.keys[w := self.losers[0]] is not None:
            yield self.heads[w]
            self.heads[w] = next(self.runs[w], None)
            self.keys[w] = None if self.heads[w] is None else self.key(self.heads[w])
            self._play(w)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a key range, run after run, in the order of their keys."""
    whole = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if whole is None:
        return
    run = whole.column("run").to_pylist()
    keys = list(zip(whole.column("url_key").to_pylist(), whole.column("captured_at").to_pylist(), whole.column("page_id").to_pylist()))
    starts = [i for i in range(len(run)) if not i or run[i] != run[i - 1]]
    pieces = [iter(range(a, b)) for a, b in zip(starts, [*starts[1:], len(run)])]
    order = list(LoserTree(pieces, lambda i: _order(keys[i])))
    yield from whole.select(_NAMES).take(pa.array(order, pa.int64())).combine_chunks().to_batches()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The archives' captures in sorted runs: run, seq and the columns of ENTRY."""
    small_batches(spark)
    return spark.read.option("lineSep", BREAK).text(path).select("value").mapInArrow(_runs, f"run bigint, seq bigint, {ENTRY}")


def capture_index(runs: DataFrame) -> DataFrame:
    """The captures of sorted runs in one order by URL key, time and page_id: partition after partition."""
    runs = written(runs)
    ranges = shuffle_width(runs.sparkSession, -(-runs.count() // RANGE))
    return runs.repartitionByRange(ranges, "url_key", "captured_at", "page_id").sortWithinPartitions("run", "seq").mapInArrow(_merged, ENTRY)


def archive_and_index(pages: DataFrame) -> DataFrame:
    """Writes the pages' archives to the shared folder, reads them back and returns the capture index."""
    path = shared_dir(pages.sparkSession)
    write_archives(pages, path)
    return capture_index(read_archives(pages.sparkSession, path))
