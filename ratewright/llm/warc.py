"""WARC archives with revisit records, and an external index merge over them.

Writing: captures with equal payloads of at least ``LEAST`` bytes become one response
(the one of the largest id) and revisits that refer to it; a digest's group is found by
aggregation. Each record is one text row and the record separator is the line
separator, so Spark's own writer makes the archive files (gzip) in any store.

Reading: a task reads an archive front to back by the records' Content-Length, checks
every payload against its digest, and yields the archive's captures as a run sorted by
URL key and timestamp. ``merge_index`` deals all runs into key ranges; in each range a
loser tree merges the k runs, which gives globally ordered capture histories. A range
holds index entries only, never payloads, and the page id ends the range key, so a URL
that fills a third of the captures is cut into several ranges.

Defined cases: null html is an empty payload; null urls are empty; line breaks in a url
are percent-encoded in the record; null ids and repeated rows are captures of their
own (equal ids of equal payloads are then all responses); an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 1000
PER_FILE = 4000  # records
EPOCH = "2024-01-01T00:00:00Z"
URN = "urn:capture:"


def capture_records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(value): the records of ``pages(page_id, url, html)`` without their separator."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    captures = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        # a line break would end the header; percent signs are kept apart from it
        F.replace(
            F.replace(
                F.replace(F.coalesce(F.col("url").cast("string"), F.lit("")), F.lit("%"), F.lit("%25")),
                F.lit("\r"),
                F.lit("%0D"),
            ),
            F.lit("\n"),
            F.lit("%0A"),
        ).alias("url"),
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("digest"),
        F.octet_length(html).alias("size"),
    )
    shared = (
        captures.where(F.col("size") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND kept IS NOT NULL")
        .select("digest", "kept")
    )
    joined = captures.join(shared, "digest", "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    name = lambda c: F.concat(F.lit(f"<{URN}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    stamp = F.date_format(
        F.timestamp_seconds(F.unix_timestamp(F.to_timestamp(F.lit(EPOCH))) + F.coalesce(F.col("page_id"), F.lit(0))),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    return joined.select(
        F.concat(
            F.lit("WARC/1.1\r\nWARC-Type: "),
            F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
            F.lit("\r\nWARC-Record-ID: "),
            name(F.col("page_id")),
            F.lit("\r\nWARC-Date: "),
            stamp,
            F.lit("\r\nWARC-Target-URI: "),
            F.col("url"),
            F.lit("\r\nWARC-Payload-Digest: sha1:"),
            F.col("digest"),
            F.when(
                revisit,
                F.concat(
                    F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    F.lit("\r\nWARC-Refers-To: "),
                    name(F.col("kept")),
                ),
            ).otherwise(F.lit("")),
            F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
            F.octet_length(block).cast("string"),
            F.lit("\r\n\r\n"),
            block,
        ).alias("value")
    )


def write_archives(pages: DataFrame, path: str, least: int = LEAST) -> None:
    capture_records(pages, least).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", PER_FILE
    ).text(path)


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then the rest, lower-cased."""
    match = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?(.*)", url, re.IGNORECASE | re.DOTALL)
    if not match:
        return url.lower()
    return ",".join(reversed(match[1].lower().split("."))) + ")" + (match[2].lower() or "/")


class _Stream:
    """Exact reads from a gzip file held in memory, one piece unpacked at a time."""

    def __init__(self, data: memoryview) -> None:
        self._data, self._at, self._unzip, self._held = data, 0, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        if self._at >= len(self._data):
            return False
        piece = self._data[self._at : self._at + (1 << 18)]
        self._at += len(piece)
        self._held += self._unzip.decompress(piece)
        return True

    def head(self) -> bytes | None:
        """Bytes up to the next empty line, or None at the end."""
        while (end := self._held.find(b"\r\n\r\n")) < 0:
            if not self._more():
                return None
        out, self._held = self._held[:end], self._held[end + 4 :]
        return out

    def take(self, count: int) -> bytes:
        while len(self._held) < count:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out, self._held = self._held[:count], self._held[count:]
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}


INDEX = (
    "url_key string, stamp string, page_id bigint, url string, record_type string, payload_bytes bigint,"
    " payload_digest string, refers_to bigint, run string, place int"
)
_NAMES = [c.split()[0] for c in INDEX.split(",")]
_KINDS = [
    {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[c.split()[1]] for c in INDEX.split(",")
]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES)


def _number(name: str | None) -> int | None:
    text = name.removeprefix(f"<{URN}").removesuffix(">") if name else ""
    return int(text) if text else None


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            stream, rows = _Stream(memoryview(content.as_buffer())), []
            while (head := stream.head()) is not None:
                record = _fields(head)
                block = stream.take(int(record["content-length"]))
                http, _, payload = block.partition(b"\r\n\r\n")
                if stream.take(4) != b"\r\n\r\n":
                    raise ValueError("no separator after a record")
                digest = record["warc-payload-digest"].removeprefix("sha1:")
                if record["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError("payload does not match its digest")
                url = unquote(record.get("warc-target-uri", ""))
                rows.append(
                    (
                        url_key(url),
                        record["warc-date"],
                        _number(record["warc-record-id"]),
                        url,
                        record["warc-type"],
                        int(_fields(http)["content-length"]),
                        digest,
                        _number(record.get("warc-refers-to")),
                        path,
                        len(rows),
                    )
                )
            yield _batch(sorted(rows, key=_order))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of the archives below ``path``: one sorted run per archive."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_runs, INDEX)


class LoserTree:
    """Merges k sorted lists. Inner nodes keep the losers of their matches; node 0 the winner."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self._runs, self._at, self._k = runs, [0] * len(runs), len(runs)
        self._nodes = [-1] * max(1, self._k)
        for run in range(self._k):
            self._play(run)

    def _key(self, run: int) -> tuple:
        rows, at = self._runs[run], self._at[run]
        return (0, _order(rows[at]), run) if at < len(rows) else (1, (), run)

    def _play(self, run: int) -> None:
        node = (run + self._k) // 2
        while node > 0:
            other = self._nodes[node]
            if other < 0:  # the first of a pair waits for its opponent
                self._nodes[node] = run
                return
            if self._key(other) < self._key(run):
                self._nodes[node], run = run, other
            node //= 2
        self._nodes[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self._k:
            run = self._nodes[0]
            if self._at[run] >= len(self._runs[run]):
                return
            yield self._runs[run][self._at[run]]
            self._at[run] += 1
            self._play(run)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            runs.setdefault(row[8], []).append(row)
    for rows in runs.values():
        rows.sort(key=_order)  # linear where the shuffle kept the run's order
    task = TaskContext.get()
    part = task.partitionId() if task else 0
    held: list[tuple] = []
    number = 0

    def ready() -> pa.RecordBatch:
        out = _batch(held)
        numbers = pa.array(range(number - len(held), number), pa.int64())
        return pa.RecordBatch.from_arrays(
            [*out.columns, pa.array([part] * len(held), pa.int64()), numbers], names=[*_NAMES, "range", "number"]
        )

    for row in LoserTree(list(runs.values())):
        held.append(row)
        number += 1
        if len(held) == 10_000:
            yield ready()
            held.clear()
    yield ready()


def merge_index(runs: DataFrame) -> DataFrame:
    """All captures in order of (url_key, stamp, page_id): by ``range``, then by ``number``."""
    return runs.repartitionByRange("url_key", "stamp", "page_id").mapInArrow(
        _merge, f"{INDEX}, range bigint, number bigint"
    )
