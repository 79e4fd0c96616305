"""WARC archives as a chunked record table.

A record is written and read in pieces of bounded size. Writing: a task streams the payloads it reads, piece by piece, into
compressed archives of the shared folder; a payload that an earlier record holds becomes a revisit record without a
payload. Reading: an archive is streamed into rows of record id and chunk number, each with its bytes, the payload's bytes
so far and the digest so far, so the row marked ``last`` carries the length and digest of the whole payload and no record
has to be in memory as a whole.

The digest pass and the writing pass shuffle digests and, if there are too many repeated payloads to broadcast by Spark's
own threshold, payloads once. A task that runs again writes archives of its own; only the archives of the run that
succeeded are in the list of archives, so a lost executor leaves no record twice.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm.common import shared_folder, stored, table, text_of
from stockloom.shipping import ship_with_tasks

LEAST_REVISIT = 100  # bytes; smaller payloads are always written out
CHUNK = 1 << 20  # bytes of a payload that are handled at a time
ARCHIVE = 1 << 30  # compressed bytes after which a task begins another archive
HEAD = 1 << 16  # longest header that is read
RESPONSE, REVISIT = "response", "revisit"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "archive string, record_id string, record_type string, page_id bigint, url string, refers_to bigint, chunk_no int, data binary, bytes_so_far bigint, digest_so_far string, last boolean, payload_bytes bigint, payload_digest string"


def record_types(pages: DataFrame, page_id: str = "page_id", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` as ``page_id, url, payload, digest, refers_to``; ``refers_to`` is null for a response.

    Of the records with the same payload of at least ``least`` bytes the one with the smallest id is the response. Rows
    that share this id are all responses; null ids come last, and are responses if no other record has their payload.
    """
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(text_of(html), "utf-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= least
    several = rows.where(long_enough).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1 and first is not null")
    # written first, so that its size is known: a small one is broadcast, a skewed join with a large one can be split
    several = stored(several.select(F.col("digest").alias("seen"), "first"), "repeated-payloads")
    joined = rows.join(several, (rows["digest"] == several["seen"]) & long_enough, "left")
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", F.when(F.col("first").isNotNull() & later, F.col("first")).alias("refers_to"))


# --- writing ------------------------------------------------------------------------------------------------------


def pieces(data: memoryview, size: int = CHUNK) -> Iterator[memoryview]:
    """Views of ``data``, nothing is copied."""
    for start in range(0, len(data), size):
        yield data[start : start + size]


def record_name(page_id: int | None, place: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{place}>"


def one_line(value: str) -> str:
    """A header value: line ends and other control characters would break the record."""
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in value)


class Archive:
    """One compressed file; every record is a compressed member of its own."""

    def __init__(self, out, path: str) -> None:
        self.out, self.path, self.records, self.size = out, path, 0, 0
        info = b"format: WARC File Format 1.1\r\n"
        self.add({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:archive:{path.rsplit('/', 1)[-1]}>", "Content-Type": "application/warc-fields"}, info, memoryview(b""))
        self.records = 0

    def add(self, fields: dict[str, str], head: bytes, payload: memoryview) -> None:
        packer = zlib.compressobj(4, zlib.DEFLATED, 31)
        lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
        self._put(packer.compress(f"WARC/1.1\r\n{lines}Content-Length: {len(head) + len(payload)}\r\n\r\n".encode() + head))
        for piece in pieces(payload):
            self._put(packer.compress(piece))
        self._put(packer.compress(b"\r\n\r\n") + packer.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()


def opener(folder: str) -> tuple:
    """File system and path of a folder named by a URI or a plain path; found again in each task."""
    from pyarrow import fs

    if "://" not in folder and ":" in folder.split("/", 1)[0]:  # file:/x as Hadoop writes it
        scheme, path = folder.split(":", 1)
        folder = f"{scheme}://{path}"
    return fs.FileSystem.from_uri(folder)


def written(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of :func:`record_types` below ``folder``; the list of archives: ``archive, records, bytes``.

    Each task writes what it reads. ``folder`` is a URI or path that every executor reaches.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opener(folder)
        system.create_dir(base, recursive=True)
        run, archive, done, n = uuid.uuid4().hex, None, [], 0
        for batch in batches:
            ids, urls, payloads, digests, first = (batch.column(i) for i in range(5))
            for i in range(batch.num_rows):
                if archive is None or archive.size >= archive_bytes:
                    if archive is not None:
                        archive.close()
                    name = f"{run}-{len(done):05d}.warc.gz"
                    archive = Archive(system.open_output_stream(f"{base}/{name}", compression=None), f"{folder.rstrip('/')}/{name}")
                    done.append(archive)
                page, origin = ids[i].as_py(), first[i].as_py()
                buffer = payloads[i].as_buffer()
                payload = memoryview(buffer if buffer is not None else b"").cast("B")
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                url = urls[i].as_py()
                fields = {
                    "WARC-Type": RESPONSE if origin is None else REVISIT,
                    "WARC-Record-ID": record_name(page, f"{run}-{n}"),
                    "WARC-Date": date,
                    "WARC-Target-URI": None if url is None else one_line(url),
                    "WARC-Payload-Digest": f"sha256:{digests[i].as_py()}",
                    "WARC-Refers-To": None if origin is None else record_name(origin, ""),
                    "WARC-Profile": None if origin is None else SAME_PAYLOAD,
                    "Content-Type": "application/http; msgtype=response",
                }
                archive.add(fields, head, payload if origin is None else memoryview(b""))
                n += 1
        if archive is not None:
            archive.close()
        yield pa.RecordBatch.from_arrays([pa.array([a.path for a in done], pa.string()), pa.array([a.records for a in done], pa.int64()), pa.array([a.size for a in done], pa.int64())], ["archive", "records", "bytes"])

    return stored(records.mapInArrow(write, "archive string, records bigint, bytes bigint"), "archives")


# --- reading ------------------------------------------------------------------------------------------------------


class Inflated:
    """Bytes of an archive, compressed or not, a bounded part at a time."""

    def __init__(self, read: Callable[[int], bytes], chunk: int) -> None:
        self.read, self.chunk = read, max(chunk, 2)
        self.buffer, self.raw, self.ended, self.used = b"", b"", False, 0
        self.raw = read(self.chunk)
        self.unpack = zlib.decompressobj(31) if self.raw[:2] == b"\x1f\x8b" else None

    def _more(self) -> bytes:
        """The next bytes, empty at the end."""
        while True:
            if not self.raw and not self.ended:
                self.raw = self.read(self.chunk)
                self.ended = not self.raw
            if self.unpack is None:
                out, self.raw = self.raw, b""
                return out
            if not self.raw:
                if not self.unpack.eof:
                    raise EOFError("an archive ends inside a record")
                return b""
            if self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
            out = self.unpack.decompress(self.raw, self.chunk)
            self.raw = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            if out:
                return out
            if not self.raw and self.ended and not self.unpack.eof:
                raise EOFError("an archive ends inside a record")

    def line(self) -> bytes | None:
        """A line without its end; None at the end of the archive."""
        while b"\n" not in self.buffer:
            if len(self.buffer) > HEAD:
                raise ValueError("a header line is too long")
            more = self._more()
            if not more:
                if self.buffer:
                    raise EOFError("an archive ends inside a line")
                return None
            self.buffer += more
        found, self.buffer = self.buffer.split(b"\n", 1)
        self.used += len(found) + 1
        return found.rstrip(b"\r")

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes in pieces."""
        while size:
            if not self.buffer:
                self.buffer = self._more()
                if not self.buffer:
                    raise EOFError("an archive ends inside a record")
            piece, self.buffer = self.buffer[:size], self.buffer[size:]
            size -= len(piece)
            self.used += len(piece)
            yield piece


@dataclass
class Record:
    fields: dict[str, str]
    length: int
    http: dict[str, str] = field(default_factory=dict)
    payload: int = 0  # bytes in this record


def _fields(source: Inflated) -> dict[str, str]:
    """Header fields up to the empty line, names in lower case."""
    found, begin, name = {}, source.used, ""
    while True:
        line = source.line()
        if line is None:
            raise EOFError("an archive ends inside a header")
        if not line:
            return found
        if source.used - begin > HEAD:
            raise ValueError("a header is too long")
        if line[:1] in b" \t" and name:  # a folded line continues the value before it
            found[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, _, value = line.decode("utf-8", "replace").partition(":")
        name = name.strip().lower()
        found[name] = value.strip()


def records_of(source: Inflated) -> Iterator[tuple[Record, Iterator[bytes]]]:
    """Each record with its payload in pieces. The payload must be used up before the next record is asked for."""
    while True:
        line = source.line()
        if line is None:
            return
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a record doesn't begin with its version")
        fields = _fields(source)
        record = Record(fields, int(fields["content-length"]))
        left = record.length
        if fields.get("content-type", "").startswith("application/http") and left:
            begin = source.used
            source.line()  # status or request line
            record.http = _fields(source)
            left -= source.used - begin
        record.payload = left
        yield record, source.take(left)


def _page(name: str | None) -> int | None:
    """The page id in a record name."""
    parts = (name or "").strip("<>").split(":")
    return int(parts[2]) if len(parts) == 4 and parts[:2] == ["urn", "page"] and parts[2] else None


def chunk_rows(source: Inflated, chunk: int) -> Iterator[tuple]:
    """Rows of the chunked record table: pieces are joined up to ``chunk`` bytes, the digest goes on from piece to piece."""
    for record, payload in records_of(source):
        f = record.fields
        head = (f.get("warc-record-id"), f.get("warc-type"), _page(f.get("warc-record-id")), f.get("warc-target-uri"), _page(f.get("warc-refers-to")))
        declared = f.get("warc-payload-digest", "").partition(":")[2] or None
        full = int(record.http["content-length"]) if f.get("warc-type") == REVISIT and "content-length" in record.http else record.payload
        digest, total, number, held = hashlib.sha256(), 0, 0, b""
        for piece in payload:
            while piece:
                room = chunk - len(held)
                held, piece = held + piece[:room], piece[room:]
                if len(held) == chunk and (piece or total + chunk < record.payload):
                    digest.update(held)
                    total += len(held)
                    yield *head, number, held, total, digest.copy().hexdigest(), False, full, declared
                    held, number = b"", number + 1
        digest.update(held)
        total += len(held)
        found = digest.hexdigest()
        if f.get("warc-type") == RESPONSE and declared and found != declared:
            raise ValueError(f"payload of {head[0]} differs from its digest")
        yield *head, number, held, total, found, True, full, declared


def read_archives(archives: DataFrame, chunk: int = CHUNK, path: str = "archive") -> DataFrame:
    """The chunked record table of archives (one path or URI a row); warcinfo records are rows as well.

    Each archive is read by one task, in bounded memory. A payload that differs from its declared digest, and an
    archive that breaks off, are errors. An empty list gives no rows.
    """
    parts = max(1, archives.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in CHUNKS.split(", ")]
        kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
        types = [kinds[c.split()[1]] for c in CHUNKS.split(", ")]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            for place in batch.column(0).to_pylist():
                system, inner = opener(place)
                held, size = [], 0
                with system.open_input_stream(inner, compression=None) as stream:
                    for row in chunk_rows(Inflated(stream.read, max(chunk, HEAD)), chunk):
                        held.append((place, *row))
                        size += len(row[6]) + 500
                        if size >= 4 * chunk:
                            yield out(held)
                            held, size = [], 0
                if held:
                    yield out(held)

    return archives.select(path).repartition(parts, path).mapInArrow(read, CHUNKS)


def payload_facts(chunks: DataFrame) -> DataFrame:
    """One row per response or revisit: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.

    Taken from the last chunk, which carries the digest of the whole payload; a revisit has what its header declares.
    """
    read = F.col("record_type") == RESPONSE
    return chunks.where(F.col("last") & F.col("record_type").isin(RESPONSE, REVISIT)).select(
        "page_id",
        "url",
        F.when(read, F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(read, F.col("digest_so_far")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def payloads(chunks: DataFrame, most: int) -> DataFrame:
    """``record_id, payload`` of responses of at most ``most`` bytes, put together from their chunks; longer ones stay in
    chunks."""
    small = chunks.where((F.col("record_type") == RESPONSE) & (F.col("payload_bytes") <= most))
    parts = F.array_sort(F.collect_list(F.struct("chunk_no", "data")))
    return small.groupBy("record_id").agg(F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["data"])).alias("payload"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    archives = written(record_types(table(spark, sf_dir, "pages")), folder)
    return payload_facts(read_archives(archives)).drop("url")


#: What the query must give, stated over the table itself.
SQL = f"""
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (
  select payload_digest, min(page_id) as first from p where payload_bytes >= {LEAST_REVISIT} group by 1
)
select p.page_id, p.payload_bytes, p.payload_digest,
  case when coalesce(p.page_id > f.first, f.first is not null) then 'revisit' else 'response' end as record_type,
  case when coalesce(p.page_id > f.first, f.first is not null) then f.first end as refers_to
from p left join f on p.payload_digest = f.payload_digest and p.payload_bytes >= {LEAST_REVISIT}
"""

ship_with_tasks(__name__)
