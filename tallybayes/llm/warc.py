"""WARC archives: monolithic gzip files, normalised to one gzip member a record.

``write_monolithic`` writes pages as WARC/1.1 records with Spark's text writer, each
archive one gzip stream.  ``normalise`` inflates every such stream once, compresses
each record as a member of its own and writes, with the members, a sidecar index
(record id, offset, length), so a record can be read by seeking.  ``read_records``
reads archives back, member by member.  Everything goes through Spark's readers and
writers, so archives may lie in any store that Spark reaches.

Spark's text writer ends each row with a separator, and this makes real archives
of its files: a record ends in CR LF CR LF, whose last LF is the separator; a
gzip member ends in the high byte of its size, NUL for records under 16 MB
(a larger one is followed by an empty member), which is the separator there.

Payloads are compared by SHA-1 over whole payloads of ``least`` bytes or more: the
record with the smallest page_id is the ``response``, others are ``revisit`` records
that name it.  Defined cases: a null payload is empty; pages that share the smallest
id and the payload are all responses; a page without an id is a revisit, unless none
of its copies has an id; line breaks in URLs are percent-encoded and a null URL is
written as about:blank; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybayes.session import scratch_dir

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
STEP = 1 << 14
HTTP = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"


def base32(digest: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hex: each ten hex digits are eight letters."""
    def letters(i: int) -> list[Column]:
        bits = F.conv(F.substring(digest, 10 * i + 1, 10), 16, 10).cast("bigint")
        return [F.substring(F.lit(ALPHABET), (F.shiftright(bits, s).bitwiseAND(31) + 1).cast("int"), F.lit(1))
                for s in range(35, -1, -5)]

    return F.concat(*[c for i in range(4) for c in letters(i)])


def with_roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               least: int = 0) -> DataFrame:
    """``(page_id, url, payload, bytes, sha1, kind, refers_to)``."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("payload")) \
        .withColumn("bytes", F.octet_length("payload").cast("bigint")) \
        .withColumn("sha1", F.sha1("payload"))
    first = rows.groupBy("sha1", "bytes").agg(F.min("page_id").alias("first"))
    own = (F.col("bytes") < least) | F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, ["sha1", "bytes"]).select(
        "page_id", "url", F.when(own, F.col("payload")).alias("payload"), "bytes", "sha1",
        F.when(own, "response").otherwise("revisit").alias("kind"), F.when(~own, F.col("first")).alias("refers_to"))


def record(date: str) -> Column:
    """The WARC record of a row of ``with_roles``, without the last line feed."""
    target = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("about:blank")), "\r", "%0D"), "\n", "%0A")
    block = F.concat(F.lit(HTTP + "Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2),
                     F.coalesce("payload", F.lit("")))

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))

    revisit = F.when(F.col("kind") == "revisit", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), header("WARC-Type", F.col("kind")),
        header("WARC-Record-ID", F.concat(F.lit("<urn:sha1:"), F.sha1(F.concat_ws(
            " ", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), target, "sha1")), F.lit(">"))),
        header("WARC-Date", F.lit(date)), header("WARC-Target-URI", target),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        header("WARC-Profile", revisit), header("X-Page-Id", F.col("page_id")),
        header("X-Refers-To-Page-Id", F.col("refers_to")),
        header("Content-Type", F.lit("application/http;msgtype=response")),
        header("Content-Length", F.octet_length(block)), F.lit(CRLF), block, F.lit("\r\n\r"))


def write_monolithic(rows: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
                     records_per_file: int = 5000) -> None:
    """Archives of at most ``records_per_file`` records, one gzip stream each."""
    rows.select(record(date).alias("value")).write.option("compression", "gzip") \
        .option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(path)


def _records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream, by their Content-Length."""
    buffer = bytearray()
    need = None
    for part in stream:
        buffer += part
        while True:
            if need is None:
                head = buffer.find(b"\r\n\r\n")
                if head < 0:
                    break
                fields = dict(x.split(b": ", 1) for x in bytes(buffer[:head]).split(b"\r\n")[1:])
                need = head + 4 + int(fields[b"Content-Length"]) + 4
            if len(buffer) < need:
                break
            yield bytes(buffer[:need])
            del buffer[:need]
            need = None
    if buffer:
        raise ValueError(f"an archive ends within a record ({len(buffer)} bytes left)")


def _inflate(content: memoryview, step: int = 1 << 20) -> Iterator[bytes]:
    """A gzip file's bytes, all its members, in pieces."""
    engine, rest = zlib.decompressobj(31), content
    while len(rest) or engine.unconsumed_tail:
        if engine.eof:
            engine = zlib.decompressobj(31)
        if engine.unconsumed_tail:
            yield engine.decompress(engine.unconsumed_tail, step)
        else:
            yield engine.decompress(rest[:step], step)
            used = min(step, len(rest))
            rest = rest[used - len(engine.unused_data):] if engine.eof else rest[used:]


def _member(data: bytes, level: int) -> bytes:
    engine = zlib.compressobj(level, zlib.DEFLATED, 31)
    return engine.compress(data) + engine.flush()


def normalise(spark, source: str, target: str, level: int = 6) -> None:
    """Rewrites the archives in ``source`` to ``target``/kind=warc, one member a record,
    with the index of each in the file of the same number in ``target``/kind=index."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(source).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, number = 0, 0
        for batch in batches:
            for cell in batch.column(0):
                kinds, numbers, values = [], [], []
                size = 0

                def out() -> pa.RecordBatch:
                    made = pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(numbers, pa.int64()),
                                                       pa.array(values, pa.binary())], ["kind", "number", "value"])
                    for x in (kinds, numbers, values):
                        x.clear()
                    return made

                for data in _records(_inflate(memoryview(cell.as_buffer()))):
                    member = _member(data, level)
                    if member[-1]:
                        member += _member(b"", level)
                    name = data[data.index(b"WARC-Record-ID: ") + 16:].split(b"\r\n", 1)[0]
                    for kind, value in (("index", b"%d\t%d\t%s" % (at, len(member), name)), ("warc", member[:-1])):
                        kinds.append(kind)
                        numbers.append(number)
                        values.append(value)
                    at, number, size = at + len(member), number + 1, size + len(member)
                    if size > 1 << 22:
                        yield out()
                        size = 0
                if kinds:
                    yield out()

    rows = files.mapInArrow(run, "kind string, number bigint, value binary")
    rows.sortWithinPartitions("kind", "number").select("kind", F.col("value").cast("string").alias("value")) \
        .write.partitionBy("kind").option("lineSep", "\0").text(target)


def read_index(spark, target: str) -> DataFrame:
    """``(part, offset, length, record_id)``: where each record's member lies."""
    path = F.col("_metadata.file_path")
    rows = spark.read.option("lineSep", "\0").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*") \
        .text(target).filter(path.contains("/kind=index/") | path.contains("/kind%3Dindex/")) \
        .select(F.regexp_extract(path, r"/(part-\d+)", 1).alias("part"), F.split("value", "\t").alias("f"))
    return rows.select("part", F.col("f")[0].cast("bigint").alias("offset"), F.col("f")[1].cast("bigint").alias("length"),
                       F.col("f")[2].alias("record_id"))


def read_records(spark, target: str) -> DataFrame:
    """``(part, offset, page_id, url, kind, refers_to, digest, bytes, payload)`` of all records in
    ``target``; ``digest`` and ``bytes`` of a response are taken from its payload anew."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true") \
        .load(target).filter(F.col("path").contains("/kind=warc/")).select(F.regexp_extract("path", r"/(part-\d+)", 1).alias("part"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64
        import hashlib

        for batch in batches:
            for part, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                rest, at, rows, size = memoryview(cell.as_buffer()), 0, [], 0
                while len(rest):
                    # piece by piece: what lies behind a member's end is copied each time
                    engine, pieces, length = zlib.decompressobj(31), [], 0
                    while not engine.eof:
                        pieces.append(engine.decompress(rest[length:length + STEP]))
                        length = min(length + STEP, len(rest)) - len(engine.unused_data)
                    data, rest = b"".join(pieces), rest[length:]
                    if data:
                        head, block = data.split(b"\r\n\r\n", 1)
                        h = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
                        http, body = block[:int(h[b"Content-Length"])].split(b"\r\n\r\n", 1)
                        kind = h[b"WARC-Type"].decode()
                        digest, n = h[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"), \
                            int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
                        if kind == "response":
                            found = base64.b32encode(hashlib.sha1(body).digest()).decode()
                            if (found, len(body)) != (digest, n):
                                raise ValueError(f"{part} at {at}: payload {found} isn't {digest}")
                        as_int = lambda k: int(h[k]) if k in h else None  # noqa: E731, B023
                        rows.append((part, at, as_int(b"X-Page-Id"), h[b"WARC-Target-URI"].decode(), kind,
                                     as_int(b"X-Refers-To-Page-Id"), digest, n, body if kind == "response" else None))
                        size += len(body)
                    at += length
                    if rows and (size > 1 << 22 or not len(rest)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], NAMES)
                        rows, size = [], 0

    return files.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(NAMES, (
        "string", "bigint", "bigint", "string", "string", "bigint", "string", "bigint", "binary"))))


NAMES = ["part", "offset", "page_id", "url", "kind", "refers_to", "digest", "bytes", "payload"]
TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]


def archive_pages(pages: DataFrame, least: int = 0) -> str:
    """Writes, normalises; returns the folder of the normalised archives."""
    spark = pages.sparkSession
    raw, target = scratch_dir(spark, "warc-raw"), scratch_dir(spark, "warc")
    write_monolithic(with_roles(pages, least=least), raw)
    normalise(spark, raw, target)
    return target
