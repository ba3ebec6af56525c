"""WARC archives: written by Spark's text writer, read by a Python data source.

A record is header lines, an empty line, a block and two line ends, so a file
written as text with ``\\r\\n\\r\\n`` between rows is an archive: bytes go from the
JVM to the file system with Spark's own commit protocol, on any store it can
write to. Reading plans one partition per archive, reads the header of a record
first, and skips the block of every record that the pushed filters refuse or
whose payload is not asked for. Archives are listed and read by pyarrow: local paths
and the stores it has a file system for (hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from stockweave.session import materialize

# Payloads shorter than this are stored again rather than referred to.
REVISIT_BYTES = 1000
# An archive is read by one task, so files are kept small enough for one.
RECORDS_PER_FILE = 5_000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BATCH_BYTES = 4 * 1024 * 1024
_READ_BYTES = 256 * 1024
_NEWLINE = "\r\n"

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, "
    "content_type string, payload_digest string, refers_to string, "
    "headers map<string,string>, payload binary"
)
# Header line that holds a column, lower case.
HEADER_OF = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "content_type": "content-type",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}


# --- writing -----------------------------------------------------------------


def _uuid(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("|", *parts))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(
        F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]), F.lit(">")
    )


def _line(name: str, value: Column) -> Column:
    """``name: value``, NULL (and so no line) for NULL; line ends cannot get in."""
    plain = F.regexp_replace(F.regexp_replace(value.cast("string"), "\r", "%0D"), "\n", "%0A")
    return F.concat(F.lit(f"{name}: "), plain)


def records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(record): one WARC record, without its closing line ends, per row of ``pages``.

    The payload is the html in UTF-8, empty for NULL. Of rows with equal payloads
    of at least ``REVISIT_BYTES`` the one with the largest id is a response and
    the others revisit it; rows that share the largest id, rows whose equals all
    have a NULL id, and shorter payloads are all responses. NULL ids and urls
    have no header line. Every row gives a record; repeated rows repeat it.
    """
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        html.alias("payload"),
        F.octet_length(html).cast("long").alias("bytes"),
        F.sha1(html.cast("binary")).alias("digest"),
    )
    # Only groups of two and more, written down: small tables are then broadcast
    # by their true size, large ones are joined by key with skewed keys split.
    shared = materialize(
        rows.where(F.col("bytes") >= REVISIT_BYTES)
        .select("digest", "id")
        .groupBy("digest")
        .agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and last is not null")
        .select("digest", "last")
    )
    rows = rows.join(shared, "digest", "left")
    revisit = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(_NEWLINE * 2),
    )
    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, F.col("payload")))
    none = F.lit(None).cast("string")

    def only(value: Column) -> Column:
        return F.when(revisit, value).otherwise(none)

    head = F.concat_ws(
        _NEWLINE,
        F.lit("WARC/1.1"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _uuid(F.col("id").cast("string"), F.col("digest"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        only(_line("WARC-Profile", F.lit(PROFILE))),
        only(_line("WARC-Refers-To", _uuid(F.col("last").cast("string"), F.col("digest")))),
        only(_line("X-Refers-To-Page", F.col("last"))),
        _line("X-Page-Id", F.col("id")),
        _line("X-Payload-Length", F.col("bytes")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block)),
    )
    return rows.select(F.concat(head, F.lit(_NEWLINE * 2), block).alias("record"))


def write(
    pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, **columns: str
) -> None:
    """Write the records of ``pages`` as archives into the new folder ``path``."""
    out = records(pages, **columns).write.option("lineSep", _NEWLINE * 2)
    out.option("maxRecordsPerFile", records_per_file).text(path)


# --- reading -----------------------------------------------------------------


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class Archives(InputPartition):
    path: str


def _accepts(filters: list[tuple[str, str, object]], headers: dict[str, str]) -> bool:
    for name, test, value in filters:
        own = headers.get(name)
        if own is None:
            return False
        if test == "equals" and own != value:
            return False
        if test == "in" and own not in value:
            return False
        if test == "starts" and not own.startswith(value):
            return False
        if test == "ends" and not own.endswith(value):
            return False
        if test == "contains" and value not in own:
            return False
    return True


def read_header(stream) -> dict[str, str] | None:
    """Header fields of the next record by lower-case name; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):  # the line ends that close the record before
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    headers: dict[str, str] = {}
    name = None
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and name is not None:  # a folded line goes on
            headers[name] += " " + text.strip()
            continue
        key, _, value = text.partition(":")
        name = key.strip().lower()
        headers[name] = value.strip()
    return headers


def http_payload(block: bytes, content_type: str | None) -> bytes:
    """The body of an HTTP message block; other blocks are their own payload."""
    if content_type is None or not content_type.lower().startswith("application/http"):
        return block
    end = block.find(b"\r\n\r\n")
    return block[end + 4 :] if end >= 0 else b""


def parse(stream, filters: list, with_payload: bool) -> Iterator[tuple]:
    """Records that pass the filters, as rows of ``SCHEMA``; other blocks are not read."""
    while (headers := read_header(stream)) is not None:
        length = int(headers.get("content-length", 0))
        if not _accepts(filters, headers):
            stream.seek(length, 1)
            continue
        payload = None
        if with_payload:
            block = stream.read(length)
            if len(block) < length:
                raise ValueError("archive ends inside a record")
            payload = http_payload(block, headers.get("content-type"))
        else:
            stream.seek(length, 1)
        yield (*[headers.get(h) for h in HEADER_OF.values()], list(headers.items()), payload)


_ARROW = pa.schema(
    [(c, pa.string()) for c in HEADER_OF]
    + [("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.with_payload = str(options.get("payload", "true")).lower() == "true"
        self.filters: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take predicates on columns that are header lines, and on ``headers``; return the rest."""
        tests = {
            EqualTo: "equals",
            In: "in",
            IsNotNull: "present",
            StringStartsWith: "starts",
            StringEndsWith: "ends",
            StringContains: "contains",
        }
        for f in filters:
            test = tests.get(type(f))
            name = HEADER_OF.get(f.attribute[0]) if test and len(f.attribute) == 1 else None
            if name is None:
                yield f
                continue
            self.filters.append((name, test, getattr(f, "value", None)))

    def partitions(self) -> list[InputPartition]:
        fs, root = _filesystem(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            return [Archives(self.path)]
        files = fs.get_file_info(pafs.FileSelector(root, recursive=True))
        scheme = self.path.split("://")[0] + "://" if "://" in self.path else ""
        host = self.path.removeprefix(scheme).split("/")[0] if scheme not in ("", "file://") else ""
        return [
            Archives(f.path if not scheme else f"{scheme}{host}/{f.path.lstrip('/')}")
            for f in sorted(files, key=lambda f: f.path)
            if f.type == pafs.FileType.File and f.size and f.base_name[:1] not in "._"
        ]

    def read(self, partition: Archives | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a folder without archives
            return
        fs, path = _filesystem(partition.path)
        with fs.open_input_file(path) as raw:
            stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
            stream = io.BufferedReader(stream, _READ_BYTES)
            rows, size = [], 0
            for row in parse(stream, self.filters, self.with_payload):
                rows.append(row)
                size += 500 + len(row[-1] or b"")
                if size >= _BATCH_BYTES:
                    yield self.batch(rows)
                    rows, size = [], 0
            if rows:
                yield self.batch(rows)

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW)]
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class WarcSource(DataSource):
    """``spark.read.format("warc").option("payload", "false").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives under ``path``; without ``payload`` no block is read."""
    key = "spark.sql.python.filterPushdown.enabled"
    if key not in spark.conf.getAll:
        spark.conf.set(key, "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_digests(archives: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record.

    Of a response both figures are taken from the payload as read, of a revisit
    from its header. Records of other writers, without the page's own header
    lines, have a NULL page, and NULL figures where they are no responses.
    """
    response = F.col("record_type") == "response"
    stated = F.regexp_replace("payload_digest", "^sha1:", "")
    return archives.select(
        F.try_element_at("headers", F.lit("x-page-id")).cast("long").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long"))
        .otherwise(F.try_element_at("headers", F.lit("x-payload-length")).cast("long"))
        .alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(stated).alias("payload_digest"),
        "record_type",
        F.when(~response, F.try_element_at("headers", F.lit("x-refers-to-page")).cast("long")).alias(
            "refers_to"
        ),
    )


def stored_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_digests`` of all responses and revisits under ``path``, each read for what it needs.

    The record type is pushed down, so a read skips the blocks of the other kind;
    revisits are read without payload, so no block of theirs is read at all.
    Records of other types do not come out.
    """
    responses = read(spark, path).where("record_type = 'response'")
    revisits = read(spark, path, payload=False).where("record_type = 'revisit'")
    return page_digests(responses).unionByName(page_digests(revisits))
