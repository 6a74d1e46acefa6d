"""Web archives: WARC files of pages, read back, with a globally ordered capture index.

Records are written by Spark's text writer, whose line separator is the record end, so the
archives land wherever Spark can write. Each archive's captures form a run sorted by URL key
and time; ranges of the key space are merged from all runs with a loser tree.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook import session
from tallybook.llm.scratch import keep, map_batches

ARCHIVE_BYTES = 24 << 20  # text of an archive, about; a record is never cut
EPOCH = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
_END = b"\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "run string, url_key string, captured_at string, page_id bigint, payload_bytes bigint,"
    " payload_digest string, record_type string, refers_to bigint"
)


def url_key(url: str) -> str:
    """Sort key of a URL: host labels from the right, then the path."""
    rest = url.split("://", 1)[-1]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, path = rest[:cut].lower().rsplit("@", 1)[-1], rest[cut:]
    name, _, port = host.partition(":")
    labels = ",".join(reversed(name.split(".")))
    return f"{labels}{':' + port if port else ''}){path or '/'}"


def capture_time(page_id: int | None) -> str:
    """The tables give no capture time; it follows from the page's number."""
    seconds = (page_id or 0) % (3650 * 86400)
    return (EPOCH + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    number = record_id.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record without its end: a response with its payload, or a revisit without."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers_to is None else http
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {capture_time(page_id)}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + _END + block


def _records(batches):
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True)
        made = [
            record(page, url, (html or "").encode(), refers).decode()
            for page, url, html, refers in rows
        ]
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["value"])


def with_originals(pages: DataFrame) -> DataFrame:
    """page_id, url, html and the page that a repeated payload refers to.

    Of equal payloads the largest page_id is the original. Only payloads that occur twice or
    more are joined back, by their digest.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    payload = F.sha1(F.coalesce("html", F.lit("")).cast("binary"))
    repeated = (
        rows.groupBy(payload.alias("sha"))
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha", "original")
    )
    refers = F.when(~F.col("original").eqNullSafe(F.col("page_id")), F.col("original"))
    return (
        rows.withColumn("own_sha", payload)
        .join(repeated, F.col("own_sha") == F.col("sha"), "left")
        .select("page_id", "url", "html", refers.alias("refers_to"))
    )


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Write a record per row into gzipped WARC files below ``path``."""
    size = pages.agg(
        F.count("*").alias("n"), F.sum(F.octet_length("html")).alias("bytes")
    ).first()
    mean = (size["bytes"] or 0) / max(size["n"], 1) + 600
    records = map_batches(with_originals(pages), _records, "value string")
    (
        records.write.option("lineSep", _END.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max(1, int(archive_bytes / mean)))
        .text(path)
    )
    return path


class _Unzipped:
    """Bytes of a gzip file, unpacked as they are read."""

    def __init__(self, raw: bytes):
        self.raw, self.at = memoryview(raw), 0
        self.unzip = zlib.decompressobj(31)
        self.buffer = bytearray()

    def _fill(self) -> bool:
        while self.at < len(self.raw):
            if self.unzip.eof:
                rest = self.unzip.unused_data
                self.at -= len(rest)
                self.unzip = zlib.decompressobj(31)
            part = self.raw[self.at : self.at + (1 << 16)]
            self.at += len(part)
            more = self.unzip.decompress(part)
            self.buffer += more
            if more:
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """Bytes before the mark, which is passed; empty at the end of the file."""
        seen = 0
        while (at := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self._fill():
                return b""
        out = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._fill():
            pass
        if len(self.buffer) < n:
            raise ValueError("the archive ends inside a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def read_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzipped archive, by its stated length."""
    source = _Unzipped(raw)
    while head := source.until(_END):
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = source.take(int(fields["Content-Length"]))
        if source.take(len(_END)) != _END:
            raise ValueError("a record does not end where it says")
        yield fields, block


def _capture(run: str, fields: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(_END)
    length = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
    kind, stated = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest(payload) != stated):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    return (
        run,
        url_key(fields["WARC-Target-URI"]),
        fields["WARC-Date"],
        _page_of(fields["WARC-Record-ID"]),
        length,
        stated,
        kind,
        _page_of(refers) if refers else None,
    )


def _order(row: tuple) -> tuple:
    """URL key, time, page; a null page comes first."""
    return row[1], row[2], row[3] is not None, row[3] or 0, row[6]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


_INDEX_ARROW = pa.schema(
    [
        (n, pa.int64() if n in ("page_id", "payload_bytes", "refers_to") else pa.string())
        for n in ("run", "url_key", "captured_at", "page_id", "payload_bytes", "payload_digest",
                  "record_type", "refers_to")
    ]
)


def _runs(batches):
    """One sorted run of captures per archive."""
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            run = path.as_py()
            rows = [_capture(run, f, b) for f, b in read_records(content.as_buffer().to_pybytes())]
            yield _batch(sorted(rows, key=_order), _INDEX_ARROW)


class LoserTree:
    """Merges sorted runs: inner nodes keep the losers of their matches, so that replacing the
    winner replays one path from leaf to root."""

    def __init__(self, runs: list[Iterable], key: Callable):
        self.sources = [iter(r) for r in runs]
        self.key = key
        k = len(self.sources)
        self.heads = [self._next(i) for i in range(k)]
        self.losers = [-1] * k
        self.winner = self._build(1) if k else -1

    def _next(self, i: int):
        for row in self.sources[i]:
            return (self.key(row), row)
        return None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _build(self, node: int) -> int:
        """Winner below a node; leaves are the nodes from k on."""
        k = len(self.sources)
        if node >= k:
            return node - k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        won, lost = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self):
        k = len(self.sources)
        while k and self.heads[self.winner] is not None:
            yield self.heads[self.winner][1]
            self.heads[self.winner] = self._next(self.winner)
            node, won = (self.winner + k) // 2, self.winner
            while node >= 1:
                if self._beats(self.losers[node], won):
                    won, self.losers[node] = self.losers[node], won
                node //= 2
            self.winner = won


def _merge(batches):
    """Merge the parts of all runs that fall into one key range."""
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            runs.setdefault(row[0], []).append(row)
    # A shuffle need not keep the order of a run's rows; sorting a sorted list is one pass.
    parts = [sorted(rows, key=_order) for _, rows in sorted(runs.items())]
    out: list[tuple] = []
    for row in LoserTree(parts, _order):
        out.append(row)
        if len(out) == 10_000:
            yield _batch(out, _INDEX_ARROW)
            out = []
    yield _batch(out, _INDEX_ARROW)


def read_index(archives: DataFrame) -> DataFrame:
    """Captures of all archives in order of URL key, time and page.

    archives has path and content of each file. Runs are written once; ranges of the key
    space, which split a much captured URL by time and page, are then merged independently.
    """
    runs = keep(map_batches(archives, _runs, INDEX), "runs")
    ranged = runs.repartitionByRange("url_key", "captured_at", "page_id")
    return map_batches(ranged, _merge, INDEX)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as WARC archives, read them back and return their captures.

    pages needs ``page_id``, ``url`` and ``html``; other columns are ignored. A null html is an
    empty payload, a null url an empty one. Rows with the largest page_id of a payload are
    responses, also if that id is repeated; others are revisits, also those without an id. An
    empty table gives no rows.
    """
    spark = pages.sparkSession
    path = write_archives(pages, session.scratch_path(spark, "archives"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    merged = read_index(files.select("path", "content"))
    return merged.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        "url_key", "captured_at",
    )
