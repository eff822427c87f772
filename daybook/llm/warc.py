"""WARC archives of web pages: written with an index, read back by byte ranges.

``archive_pages`` decides for each page whether its payload is stored (response)
or points to an equal one (revisit), writes one compressed member for each record,
and with it an index row: archive, offset, length, URL, digest. Readers start from
the index. Rows are chosen there with any DataFrame filter, sorted by archive and offset,
and ranges that touch or nearly touch are read as one. ``index_archives``
makes the same index for archives from elsewhere.

A task writes archives of its own, named at random. Only the index rows of attempts
that Spark commits are kept, so a lost or repeated task leaves a file that nothing
refers to. Archives lie wherever the folder's scheme says, by Arrow's file
systems (local and mounted paths, hdfs, s3, gs); executors and driver must both reach it.

Defined results: NULL payload is empty; NULL URL gives a record without target;
white space and control characters of a URL are percent-encoded in the archive, the index keeps it as
it is; a NULL id is less than any other; pages that share the largest id of equal payloads
are all responses; repeated rows give a record each; payloads of any length are
whole; an empty table gives no archive and an empty index. Only the named columns are
read, so others may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.session import files_below

from .batches import slices, stored

ARCHIVE_BYTES = 1_000_000_000
#: A record read on the way to the next one costs less than a read of its own.
GAP_BYTES = 64_000
RANGE_BYTES = 4_000_000
#: Stored bytes of the records that one task reads.
TASK_BYTES = 32_000_000
CHUNK_BYTES = 1_000_000

RESPONSE, REVISIT = "response", "revisit"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, offset bigint, length bigint, url string, digest string, record_type string, record_id string"
RECORD = (
    "record_id string, record_type string, url string, date string, digest string, refers_to string, "
    "payload_bytes bigint, payload binary"
)
_ENDS = b"\r\n\r\n"
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")


# --- what is stored ----------------------------------------------------------------------


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32, upper case, without padding: four times 40 bits are eight digits each."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_record_types(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", min_bytes: int = 0
) -> DataFrame:
    """(id, url, payload, payload_bytes, digest, record_type, refers_to) of every page.

    Equal payloads of at least ``min_bytes`` are told by SHA-256. Their largest id
    is found by partial aggregation and stored for payloads that occur twice or
    more; pages then meet it in a join of two plain shuffles, in which adaptive execution
    splits a payload that a large share of the pages have.
    """
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), payload.alias("payload")).withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("bigint"),
            "digest": base32_sha1(F.col("payload")),
            "key": F.unhex(F.sha2("payload", 256)),
        }
    )
    shared = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.max("id").alias("last"))
        .where((F.col("n") > 1) & F.col("last").isNotNull())
        .select("key", "last")
    )
    repeats = F.col("last").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("last")))
    return rows.join(stored(shared, "payloads"), "key", "left").select(
        "id",
        "url",
        F.when(~repeats, F.col("payload")).alias("payload"),
        "payload_bytes",
        "digest",
        F.when(repeats, REVISIT).otherwise(RESPONSE).alias("record_type"),
        F.when(repeats, F.col("last")).alias("refers_to"),
    )


# --- records -----------------------------------------------------------------------------


def headed(first: bytes, fields: list[tuple[bytes, bytes]]) -> bytes:
    return b"\r\n".join([first, *[name + b": " + value for name, value in fields]]) + _ENDS


def record(kind: str, record_id: bytes, url: bytes | None, date: bytes, digest: bytes, size: int, payload: bytes, refers_to: bytes | None) -> bytes:
    """One record: its header, then the HTTP header and the payload; a revisit has no payload."""
    block = headed(b"HTTP/1.1 200 OK", [(b"Content-Type", b"text/html; charset=utf-8"), (b"Content-Length", b"%d" % size)]) + payload
    fields = [(b"WARC-Type", kind.encode()), (b"WARC-Record-ID", record_id), (b"WARC-Date", date)]
    if url is not None:
        fields.append((b"WARC-Target-URI", _UNSAFE.sub(lambda m: b"%%%02X" % m.group()[0], url)))
    if refers_to is not None:
        fields += [(b"WARC-Profile", IDENTICAL.encode()), (b"WARC-Refers-To", refers_to)]
    fields += [
        (b"WARC-Payload-Digest", b"sha1:" + digest),
        (b"Content-Type", b"application/http; msgtype=response"),
        (b"Content-Length", b"%d" % len(block)),
    ]
    return headed(b"WARC/1.1", fields) + block + _ENDS


def fields_of(head: bytes) -> dict[str, bytes]:
    """Header fields by lower-case name; the first line names the format."""
    lines = [line.partition(b":") for line in head.split(b"\r\n")[1:]]
    return {name.strip().lower().decode("latin-1"): value.strip() for name, _, value in lines}


def parsed(data: bytes, where: str) -> dict:
    """A record's columns. A response whose payload has another digest than it says is an error."""
    head, found, rest = data.partition(_ENDS)
    if not found or not head.startswith(b"WARC/"):
        raise ValueError(f"No WARC record at {where}")
    fields = fields_of(head)
    block = rest[: int(fields.get("content-length", b"0"))]
    kind = fields.get("warc-type", b"").decode()
    payload, size = block, len(block)
    if fields.get("content-type", b"").startswith(b"application/http"):
        http, _, payload = block.partition(_ENDS)
        size = int(fields_of(http).get("content-length", b"%d" % len(payload))) if kind == REVISIT else len(payload)
    digest = fields.get("warc-payload-digest", b"").removeprefix(b"sha1:").decode() or None
    if kind == RESPONSE:
        actual = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest not in (None, actual):
            raise ValueError(f"Payload digest {actual} instead of {digest} at {where}")
        digest = actual
    text = {name: fields[name].decode("utf-8", "replace") for name in ("warc-record-id", "warc-target-uri", "warc-date", "warc-refers-to") if name in fields}
    return {
        "record_id": text.get("warc-record-id"), "record_type": kind, "url": text.get("warc-target-uri"), "date": text.get("warc-date"),
        "digest": digest, "refers_to": text.get("warc-refers-to"), "payload_bytes": size,
        "payload": None if kind == REVISIT else payload,
    }


def page_urn(page_id) -> bytes:
    return b"<urn:page:%s>" % (b"" if page_id is None else str(page_id).encode())


def page_of(urn: Column) -> Column:
    """The page id in a record id, as text."""
    return F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit(""))


# --- files -------------------------------------------------------------------------------


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system and the path in it, for a path as Hadoop writes it."""
    uri = re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "/", uri))
    return fs.FileSystem.from_uri(uri)


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Archives:
    """Archives that one task writes in turn; each starts with a record about itself."""

    def __init__(self, folder: str, date: bytes, most: int):
        self.system, self.folder = file_system(folder)
        self.shown, self.date, self.most = folder.rstrip("/"), date, most
        self.out, self.name, self.size = None, None, 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        """Write a record; returns its archive, offset and length."""
        if self.out is None or self.size >= self.most:
            self.close()
            self.name, self.size = f"{uuid.uuid4().hex}.warc.gz", 0
            self.system.create_dir(self.folder, recursive=True)
            self.out = self.system.open_output_stream(f"{self.folder.rstrip('/')}/{self.name}", compression=None)
            about = b"format: WARC File Format 1.1\r\n"
            self._put(headed(b"WARC/1.1", [
                (b"WARC-Type", b"warcinfo"), (b"WARC-Record-ID", b"<urn:uuid:%s>" % str(uuid.uuid4()).encode()), (b"WARC-Date", self.date),
                (b"WARC-Filename", self.name.encode()), (b"Content-Type", b"application/warc-fields"), (b"Content-Length", b"%d" % len(about)),
            ]) + about + _ENDS)
        offset = self.size
        return f"{self.shown}/{self.name}", offset, self._put(data)

    def _put(self, data: bytes) -> int:
        packed = member(data)
        self.out.write(packed)
        self.size += len(packed)
        return len(packed)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def write_archives(records: DataFrame, folder: str, date: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``with_record_types`` as records; returns the index, stored beside the archives.

    An archive is closed once it holds ``archive_bytes``, or when its task ends.
    """
    spark = records.sparkSession
    moment = date.encode()
    names = [f.split()[0] for f in INDEX.split(", ")]

    def write(batches):
        archives = Archives(f"{folder}/archives", moment, archive_bytes)
        for batch in batches:
            for part, payloads in slices(batch, "payload"):
                rows = part.drop_columns(["payload", "url"]).to_pylist()
                urls = part.column("url").cast(pa.binary()).to_pylist()
                out = []
                for row, url, payload in zip(rows, urls, payloads):
                    digest, kind, urn = row["digest"], row["record_type"], page_urn(row["id"])
                    refers_to = page_urn(row["refers_to"]) if kind == REVISIT else None
                    data = record(kind, urn, url, moment, digest.encode(), row["payload_bytes"], payload, refers_to)
                    out.append((*archives.add(data), url, digest, kind, urn.decode()))
                columns = list(zip(*out))
                arrays = [pa.array(c, pa.int64() if n in ("offset", "length") else pa.binary() if n == "url" else pa.string()) for n, c in zip(names, columns)]
                yield pa.RecordBatch.from_arrays(arrays, names)
        archives.close()

    index = records.mapInArrow(write, INDEX.replace("url string", "url binary")).withColumn("url", F.col("url").cast("string"))
    index.write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def archive_pages(
    pages: DataFrame, folder: str, date: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
    id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
) -> DataFrame:
    """Archive pages under ``folder``, equal payloads once; returns the index."""
    return write_archives(with_record_types(pages, id_column, url_column, payload_column, min_bytes), folder, date, archive_bytes)


# --- reading -----------------------------------------------------------------------------


def ranges(rows, gap: int, most: int) -> Iterator[tuple[str, int, list[tuple[int, int]]]]:
    """(archive, start, places) of byte ranges to read, from places in order of archive and offset.

    A range goes on over places at most ``gap`` bytes further, as long as it spans at most ``most`` bytes.
    """
    archive, places, start, end = None, [], 0, 0
    for name, offset, length in rows:
        if name != archive or offset - end > gap or offset + length - start > most:
            if places:
                yield archive, start, places
            archive, places, start, end = name, [], offset, offset
        places.append((offset, length))
        end = max(end, offset + length)
    if places:
        yield archive, start, places


def read_records(index: DataFrame, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """The records that rows of an index point to, and no others.

    Rows are dealt to tasks by ranges of (archive, offset), so that a large archive
    is read by several. A revisit has no payload; its ``payload_bytes`` and
    digest are those of the full payload, its ``refers_to`` is the record that holds it.
    """
    names = [f.split()[0] for f in RECORD.split(", ")]
    schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string()) for n in names])

    def places(batches):
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in ("archive", "offset", "length")])

    def read(batches):
        opened, handle = None, None
        for archive, start, wanted in ranges(places(batches), gap, most):
            if archive != opened:
                if handle is not None:
                    handle.close()
                system, path = file_system(archive)
                opened, handle = archive, system.open_input_file(path)
            data = handle.read_at(max(o + n for o, n in wanted) - start, start)
            rows = []
            for offset, length in wanted:
                packed = data[offset - start : offset - start + length]
                plain = zlib.decompress(packed, 31) if packed[:2] == b"\x1f\x8b" else packed
                rows.append(parsed(plain, f"{archive}:{offset}"))
            yield pa.RecordBatch.from_pylist(rows, schema)
        if handle is not None:
            handle.close()

    chosen = index.select("archive", "offset", "length")
    tasks = (chosen.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES + 1
    return chosen.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset").mapInArrow(read, RECORD)


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of every record of a compressed or plain archive, read from front to back."""
    held, offset = stream.read(CHUNK_BYTES), 0
    while held:
        if held[:2] == b"\x1f\x8b":
            unpacker, parts, taken = zlib.decompressobj(31), [], 0
            while not unpacker.eof:
                parts.append(unpacker.decompress(held))
                taken += len(held) - len(unpacker.unused_data)
                held = unpacker.unused_data if unpacker.eof else stream.read(CHUNK_BYTES)
                if not held and not unpacker.eof:
                    raise ValueError(f"The archive ends within the record at {offset}")
            data = b"".join(parts)
        else:
            while _ENDS not in held:
                more = stream.read(CHUNK_BYTES)
                if not more:
                    raise ValueError(f"No WARC record at {offset}")
                held += more
            head = held.partition(_ENDS)[0]
            taken = len(head) + 8 + int(fields_of(head).get("content-length", b"0"))
            if len(held) < taken:
                held += stream.read(taken - len(held))
            data, held = held[:taken], held[taken:]
            if len(data) < taken:
                raise ValueError(f"The archive ends within the record at {offset}")
        yield offset, taken, data
        offset += taken
        held = held or stream.read(CHUNK_BYTES)


def index_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The index of all archives below a folder, whoever wrote them; records that hold no page are left out.

    One task reads an archive from front to back, a chunk at a time.
    """
    names = [f.split()[0] for f in INDEX.split(", ")]
    schema = pa.schema([(n, pa.int64() if n in ("offset", "length") else pa.string()) for n in names])
    paths = [(path,) for path, _ in files_below(spark, folder) if path.endswith((".warc", ".warc.gz"))]

    def scan(batches):
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                system, path = file_system(archive)
                rows = []
                with system.open_input_stream(path, compression=None) as stream:
                    for offset, length, data in members(stream):
                        row = parsed(data, f"{archive}:{offset}")
                        if row["record_type"] in (RESPONSE, REVISIT, "resource"):
                            rows.append({n: row.get(n) for n in names} | {"archive": archive, "offset": offset, "length": length})
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.createDataFrame(paths, "archive string").repartition(max(1, len(paths)), "archive").mapInArrow(scan, INDEX)
