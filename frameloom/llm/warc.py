"""WARC archives: writing records with segmentation and revisits; reading with segment reassembly."""

from __future__ import annotations

import gzip
import io
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm.util import make_path, new_path, table, write_table

#: Bytes of block in a segment, in an archive file (about), and in a chunk of a chunked transfer.
SEGMENT_BYTES, ARCHIVE_BYTES, CHUNK_BYTES = 64 * 1024, 8 * 1024 * 1024, 16 * 1024
#: Bytes of records that reading hands on at a time, or one record's.
BATCH_BYTES = 4 << 20
#: Payloads of at least so many bytes may be revisits of an equal one.
REVISIT_BYTES = 100

_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "type string, record_id string, uri string, page_id long, digest string, refers_to long, segment int, origin string, total long, block binary, error string"
_TYPES = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.string()]
_NAMES = [x.split()[0] for x in _RECORD.split(", ")]


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Payload in HTTP chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; chunk extensions and trailers are ignored. Raises ValueError on bad framing."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk has no size line")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        if size < 0:
            raise ValueError("a chunk has a negative size")
        if not size:
            return b"".join(out)
        if body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is shorter or longer than it says")
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def http_payload(message: bytes) -> bytes:
    """The payload of an HTTP response message, its transfer framing decoded."""
    head, gap, body = message.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("an HTTP message has no end of headers")
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    return dechunked(body) if fields.get(b"transfer-encoding", b"").endswith(b"chunked") else body


def record(kind: str, record_id: str, fields: dict[str, object], block: bytes) -> bytes:
    """A WARC 1.1 record, gzipped as a member of its own."""
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": _DATE} | {k: v for k, v in fields.items() if v is not None} | {"Content-Length": len(block)}
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def page_records(page_id: int | None, uri: str | None, payload: bytes, digest: str, first: int | None, first_uri: str | None = None, place: str = "") -> list[bytes]:
    """The records of a page: a response, in segments if it is long, or a revisit of page `first`. place tells records of equal pages apart."""
    name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page {page_id} {uri} {digest} {place}')}>"
    line = lambda x: "".join((x or "urn:none").splitlines()) or "urn:none"
    common = {"WARC-Target-URI": line(uri), "WARC-Payload-Digest": f"sha256:{digest}", "WARC-Page-ID": page_id}
    if first is not None:
        message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        refers = {"WARC-Profile": _PROFILE, "WARC-Refers-To-Target-URI": line(first_uri), "WARC-Refers-To-Date": _DATE, "WARC-Refers-To-Page": first}
        return [record("revisit", name, common | refers | {"Content-Type": "application/http; msgtype=response"}, message)]
    message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    common["Content-Type"] = "application/http; msgtype=response"
    if len(message) <= SEGMENT_BYTES:
        return [record("response", name, common, message)]
    parts = [message[i : i + SEGMENT_BYTES] for i in range(0, len(message), SEGMENT_BYTES)]
    out = [record("response", name, common | {"WARC-Segment-Number": 1}, parts[0])]
    for n, part in enumerate(parts[1:], 2):
        own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {n}')}>"
        last = {"WARC-Segment-Total-Length": len(message)} if n == len(parts) else {}
        out.append(record("continuation", own, {"WARC-Segment-Origin-ID": name, "WARC-Segment-Number": n} | last, part))
    return out


def _line(stream: io.BufferedIOBase) -> bytes:
    """The next line with its CR LF; empty at the end."""
    line = stream.readline()
    while line and not line.endswith(b"\r\n"):
        if not (more := stream.readline()):
            raise ValueError("an archive ends inside a record's headers")
        line += more
    return line


def parse_archive(data: bytes) -> Iterator[tuple]:
    """The records of an archive, gzipped or not, as rows of _RECORD, one at a time: no more than a record is unpacked. Where it can't be read on, a row with the error ends it."""
    try:
        source = io.BytesIO(data)
        stream = gzip.GzipFile(fileobj=source) if data[:2] == b"\x1f\x8b" else source  # all members
        while line := _line(stream):
            if line == b"\r\n":
                continue  # after a record
            if not line.startswith(b"WARC/"):
                raise ValueError("a record doesn't begin with a version line")
            fields = {}
            while (line := _line(stream)) != b"\r\n":
                if not line:
                    raise ValueError("an archive ends inside a record's headers")
                k, _, v = line[:-2].decode("utf-8").partition(":")
                fields[k.strip().lower()] = v.strip()
            size = int(fields["content-length"])
            block = stream.read(max(size, 0))
            if size < 0 or len(block) != size:
                raise ValueError("an archive ends inside a record")
            number = lambda k: int(fields[k]) if k in fields else None
            digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
            yield fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-target-uri"), number("warc-page-id"), digest, number("warc-refers-to-page"), number("warc-segment-number"), fields.get("warc-segment-origin-id"), number("warc-segment-total-length"), block, None
    except (ValueError, KeyError, OSError, EOFError, zlib.error) as e:
        yield (*[None] * (len(_TYPES) - 1), f"archive: {type(e).__name__} {e}")


def assembled(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of a record from its segments (number, total length if told, bytes) in any order; a repeated segment counts once.

    Raises ValueError if a segment is missing or the length isn't the total that the last one tells.
    """
    by_number = {n: (total, block) for n, total, block in segments}
    if sorted(by_number) != list(range(1, len(by_number) + 1)):
        raise ValueError("a segment is missing")
    block = b"".join(by_number[n][1] for n in sorted(by_number))
    if by_number[len(by_number)][0] != len(block):
        raise ValueError("the segments' length isn't the total that the last one tells")
    return block


def write_archives(pages: DataFrame, path: str) -> None:
    """Write pages (page_id, uri, payload binary, digest, first: the page it revisits or null, first_uri) as WARC files under path.

    Each task writes files of about ARCHIVE_BYTES, its rows in order. A file is written under a name of its attempt
    and then renamed to one that depends on task and number only: a task that runs again replaces its own
    files by equal ones. Files are opened by pyarrow, so path must be of a scheme that it knows, as local and HDFS paths are.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        task, held, size, files, row_number = TaskContext.get(), [], 0, [], 0

        def flush() -> None:
            name = f"{base}/part-{task.partitionId():06d}-{len(files):06d}.warc.gz"
            draft = f"{base}/_draft-{task.taskAttemptId()}-{len(files)}"
            with store.open_output_stream(draft, compression=None) as out:
                for x in held:
                    out.write(x)
            store.move(draft, name)
            files.append(name)

        store.create_dir(base, recursive=True)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row_number += 1
                for x in page_records(*row, f"{task.partitionId()} {row_number}"):
                    if held and size + len(x) > ARCHIVE_BYTES:
                        flush()
                        held, size = [], 0
                    held.append(x)
                    size += len(x)
        if held:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string())], names=["file"])

    pages.select("page_id", "uri", "payload", "digest", "first", "first_uri").sortWithinPartitions("page_id", "digest", "uri").mapInArrow(written, "file string").agg(F.count("*")).first()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row for each response or revisit under path: page_id, uri, type, digest, refers_to, payload, record_id and error.

    Files come from Spark's binary reader, so any store will do; a file, as it is packed, is one row, of 2 GB at most. It is unpacked record by record, and records go on
    in batches of BATCH_BYTES. Continuation records are grouped with
    their first segment by origin identifier, ordered by number and checked against the total length; then
    chunked framing is decoded. Only segmented records are shuffled. Records of other types (warcinfo, request, metadata and so on) are left out.
    A record whose segments, length or framing are wrong has an error and no payload; an archive that can't be read to its end has a row
    with the error alone, after its records. No archive gives no row.
    """

    def of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(_TYPES), _TYPES, strict=True)], names=_NAMES)

    def told(make: Callable, x: object) -> tuple[bytes | None, str | None]:
        """(what is made of x, None), or (None, the error)."""
        try:
            return make(x), None
        except ValueError as e:
            return None, str(e)

    def whole_payload(row: tuple) -> tuple:
        """A record in one piece with its payload for its block, a segment as it is."""
        kind, segment, block, error = row[0], row[6], row[9], row[10]
        return row if error or segment is not None or kind not in ("response", "revisit") else (*row[:9], *told(http_payload, block))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for row in parse_archive(content.as_py()):
                    rows.append(whole_payload(row))
                    size += len(row[9] or b"")
                    if size > BATCH_BYTES:
                        yield of(rows)
                        rows, size = [], 0
                yield of(rows)

    def joined_payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = lambda parts: http_payload(assembled([(s["segment"], s["total"], s["block"]) for s in parts]))
        for batch in batches:
            found = [told(make, parts.as_py()) for parts in batch.column("parts")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())], names=[*head, "payload", "error"])

    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select("content").mapInArrow(parsed, _RECORD)
    head = ["type", "record_id", "uri", "page_id", "digest", "refers_to"]
    known = F.col("type").isin("response", "revisit")
    whole = raw.where(F.col("segment").isNull() & (known | F.col("error").isNotNull())).select(*head, F.col("block").alias("payload"), "error")
    first = [F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in head]
    cut = raw.where("segment is not null").groupBy(F.coalesce("origin", "record_id").alias("origin")).agg(*first, F.collect_list(F.struct("segment", "total", "block")).alias("parts"))
    cut = cut.where(known | F.col("type").isNull()).withColumn("record_id", F.col("origin")).select(*head, "parts")
    kinds = "type string, record_id string, uri string, page_id long, digest string, refers_to long"
    return whole.union(cut.mapInArrow(joined_payload, f"{kinds}, payload binary, error string"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The sound rows of read_records: page_id, uri, type, digest, refers_to, payload. Those with an error are read_records' to tell."""
    return read_records(spark, path).where("error is null").drop("error", "record_id")


def archive_pages(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", html_col: str = "html", path: str | None = None) -> DataFrame:
    """Write a record for each row and read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to, payload.

    Of records whose payloads are equal and of at least REVISIT_BYTES, the one of the smallest id is a response and the
    others revisit it. A null html is empty. Rows that share that smallest id and payload are all responses; a
    null id is a response only if its payload has no other id. Repeated rows are repeated records. A revisit's
    payload is empty here; its length is that of the response. An empty table gives none.
    """
    spark, path = pages.sparkSession, path or new_path(pages.sparkSession, "warc")
    payload = F.coalesce(pages[f"`{html_col}`"].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(pages[f"`{id_col}`"].cast("long").alias("page_id"), pages[f"`{uri_col}`"].cast("string").alias("uri"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    named = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "uri")))
    least = rows.where(F.length("payload") >= REVISIT_BYTES).groupBy("digest").agg(named.alias("at"), F.count("*").alias("n")).where("n > 1").select("digest", F.col("at.page_id").alias("least"), F.col("at.uri").alias("first_uri"))
    least = write_table(least, "least-pages")  # apart from its aggregation, so that a hot digest's join can be split
    joined = rows.join(least, "digest", "left").withColumn("first", F.when(~F.col("page_id").eqNullSafe(F.col("least")), F.col("least")))
    make_path(spark, path)
    write_archives(joined, path)
    wrong = F.when(F.col("error").isNotNull(), F.concat(F.lit("a record can't be read back: "), "error")).when((F.col("type") == "response") & (F.sha2("payload", 256) != F.col("digest")), F.lit("a payload isn't what its digest says"))
    digest = F.when(wrong.isNotNull(), F.raise_error(wrong)).otherwise(F.col("digest"))
    return read_records(spark, path).select("page_id", digest.alias("payload_digest"), F.col("type").alias("record_type"), "refers_to", "payload")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archive_pages(table(spark, sf_dir, "pages"))
    records = write_table(read.select("page_id", F.length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"), "records")
    sizes = write_table(records.where("record_type = 'response'").select("payload_digest", F.col("payload_bytes").alias("full")).distinct(), "payload-sizes")
    joined = records.join(sizes, "payload_digest")
    return joined.select("page_id", F.col("full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


OP8_SQL = """
SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN octet_length(encode(body)) >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(encode(body)) >= 100 AND page_id <> least THEN least END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least FROM pages)
"""
