"""WARC archives: writing, normalising whole-file gzip streams to a member per record, reading back by index."""

from __future__ import annotations

import hashlib
import json
import posixpath
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketline.llm.common import materialise

_CRLF, _GAP = "\r\n", "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = 1 << 20
INDEX = "archive string, offset long, length long, raw_length long, record_id string, type string"


# ---------------------------------------------------------------- records as a column
def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def _lines(*parts: tuple[str, Column]) -> Column:
    return F.concat(*[x for name, value in parts for x in (F.lit(f"{name}: "), value, F.lit(_CRLF))])


def warc_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 least_bytes: int = 100, date: str = "2024-01-01T00:00:00Z", broadcast_bytes: int = 16 << 20) -> DataFrame:
    """(value): one WARC record per row, without the blank lines that end it.

    Of the rows whose payloads are equal and have ``least_bytes`` or more, those with the smallest id
    are responses, the others revisit it. Payloads are equal when their SHA-256 digests and lengths are. Null
    payloads are empty. A null id is never referred to; it revisits an equal page with an id, else it is a response.

    The digests with several ids are counted first. They are broadcast only if they fit in
    ``broadcast_bytes``; beyond that they are joined by digest.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    src = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
                       F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("size"))
    groups = materialise(src.where(F.col("size") >= least_bytes).groupBy(F.unhex("digest").alias("key"))
                         .agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null"), "equal")
    fits = groups.count() * 64 <= broadcast_bytes
    side = groups.select("key", "first")
    src = src.withColumn("key", F.unhex("digest"))
    joined = src.join(F.broadcast(side) if fits else side.hint("merge"), "key", "left")
    joined = joined.withColumn("first", F.when(F.col("size") >= least_bytes, F.col("first")))
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    # the URL goes into a header line: spaces and control characters are percent-encoded as one space
    url = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20"), F.concat(F.lit("urn:page:"), F.coalesce(F.col("page").cast("string"), F.lit("null"))))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(_GAP))
    block = F.when(again, http).otherwise(F.concat(http, "html"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _lines(("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))), ("WARC-Record-ID", _record_id(F.col("page"))),
               ("WARC-Date", F.lit(date)), ("WARC-Target-URI", url), ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest"))),
        F.when(again, _lines(("WARC-Refers-To", _record_id(F.col("first"))), ("WARC-Profile", F.lit(_PROFILE)))).otherwise(F.lit("")),
        _lines(("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", F.octet_length(block).cast("string"))),
        F.lit(_CRLF))
    return joined.select(F.concat(head, block).alias("value"))


def write_monolithic(records: DataFrame, path: str) -> None:
    """Whole-file gzip archives, a file per partition, through Spark's text writer and its committer:
    the separator of its lines is the pair of blank lines that ends a record."""
    records.write.option("lineSep", _GAP).option("compression", "gzip").text(path)


# ---------------------------------------------------------------- files from within tasks
def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def _inflate(stream) -> Iterator[bytes]:
    """The bytes of a gzip stream of one or many members, a block at a time."""
    z = None
    while raw := stream.read(_READ):
        while raw:
            z = z or zlib.decompressobj(31)
            yield z.decompress(raw)
            raw = z.unused_data if z.eof else b""
            z = None if z.eof else z
    if z is not None:
        raise ValueError("the gzip stream ends early")


def split_records(blocks: Iterator[bytes]) -> Iterator[tuple[bytes, dict[str, str]]]:
    """(record with its blank lines, header fields by lower-case name); only one record is held."""
    buf, at = bytearray(), 0

    def more() -> bool:
        nonlocal at
        for b in blocks:
            if b:
                del buf[:at]
                at = 0
                buf.extend(b)
                return True
        return False

    while True:
        while (end := buf.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if buf[at:].strip():
                    raise ValueError("a record's header ends early")
                return
        fields = parse_fields(bytes(buf[at:end]))
        size = end - at + 4 + int(fields["content-length"]) + 4
        while len(buf) - at < size:
            if not more():
                raise ValueError("a record's block ends early")
        yield bytes(buf[at:at + size]), fields
        at += size


def parse_fields(head: bytes) -> dict[str, str]:
    first, *lines = head.decode("utf-8", "replace").split(_CRLF)
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def normalise(spark: SparkSession, source: str, target: str, level: int = 6, pattern: str = "*.gz") -> int:
    """Rewrites each archive of ``source`` so that every record is a gzip member of its own, and writes a
    sidecar index (JSON lines: offset, length, ...) beside it. Returns the number of records.

    Each file is inflated once, as a stream; a task holds one record. A file and its index are
    written under names of the task attempt and then moved, and depend on the input alone, so a task that runs
    again leaves the same files. Members, if the source has some, are read as well. ``target`` is a
    URI that pyarrow's file systems open (file, hdfs, s3, gs).
    """
    fs, folder = _open(target)
    fs.create_dir(folder, recursive=True)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(source).select("path", "length")
    n_files = files.count()

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                yield pa.record_batch({"records": pa.array([_normalise_file(path, target, level)], pa.int64())})

    done = files.repartition(max(1, min(n_files, 10_000)), "path").mapInArrow(run, "records long").agg(F.sum("records")).first()[0]
    return done or 0


def _normalise_file(path: str, target: str, level: int) -> int:
    source_fs, source = _open(path)
    fs, folder = _open(target)
    name = re.sub(r"(\.txt|\.warc)?\.gz$", "", posixpath.basename(source)) + ".warc.gz"
    final = posixpath.join(folder, name)
    mark = f".{TaskContext.get().taskAttemptId()}.part"
    n = offset = 0
    with source_fs.open_input_stream(source, compression=None) as stream, \
            fs.open_output_stream(final + mark, compression=None) as out, fs.open_output_stream(final + ".idx" + mark, compression=None) as idx:
        for record, fields in split_records(_inflate(stream)):
            z = zlib.compressobj(level, zlib.DEFLATED, 31)
            member = z.compress(record) + z.flush()
            out.write(member)
            row = {"archive": name, "offset": offset, "length": len(member), "raw_length": len(record),
                   "record_id": fields.get("warc-record-id"), "type": fields.get("warc-type")}
            idx.write(json.dumps(row).encode() + b"\n")
            offset += len(member)
            n += 1
    fs.move(final + mark, final)
    fs.move(final + ".idx" + mark, final + ".idx")
    return n


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """The sidecar rows of all archives of ``target``."""
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.idx").json(target)


def read_archives(spark: SparkSession, target: str, block_bytes: int = 8 << 20) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri), one row per record.

    Records are read through the index, by offset, in any number of tasks: neighbouring records of an
    archive go together by blocks of ``block_bytes``. A response's payload is measured and hashed as
    read, and compared with its digest; a revisit tells the length and the digest in its headers.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"

    def run(batches):
        handle, opened = None, None
        for b in batches:
            rows = []
            for r in b.to_pylist():
                if r["archive"] != opened:
                    if handle is not None:
                        handle.close()
                    fs, folder = _open(target)
                    handle, opened = fs.open_input_file(posixpath.join(folder, r["archive"])), r["archive"]
                member = handle.read_at(r["length"], r["offset"])
                rows.append(_read_record(zlib.decompress(member, 31)))
            yield pa.RecordBatch.from_pylist(rows, _ROWS)
        if handle is not None:
            handle.close()

    index = read_index(spark, target).select("archive", "offset", "length", F.floor(F.col("offset") / block_bytes).alias("block"))
    return index.repartition("archive", "block").sortWithinPartitions("archive", "offset").mapInArrow(run, schema)


_ROWS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string())])


def _page(record_id: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(m[1]) if m else None


def _read_record(record: bytes) -> dict:
    end = record.index(b"\r\n\r\n")
    fields = parse_fields(record[:end])
    block = record[end + 4:-4]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    size = len(payload)
    if fields["warc-type"] == "revisit":
        size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    elif hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"{fields.get('warc-record-id')}: the payload does not have its digest")
    return {"page_id": _page(fields.get("warc-record-id")), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["warc-type"], "refers_to": _page(fields.get("warc-refers-to")),
            "target_uri": fields.get("warc-target-uri")}
