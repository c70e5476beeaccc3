"""WARC archives: a writer with revisit records, and a sequential reader of these and of others' archives."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, materialize, new_path, ship

#: Payloads shorter than this are never revisited.
MIN_REVISIT = 100
#: Compressed size from which a new archive file is begun; bytes that the reader takes at once.
ARCHIVE_BYTES = 32 << 20
READ_BYTES = 1 << 16
#: Fixed values of the format.
VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
DIGESTS = ("md5", "sha1", "sha256", "sha512")
#: Revisits up to this number, about 100 bytes each, are broadcast to the pages; more are joined in a shuffle of the pages.
BROADCAST_REVISITS = 500_000


class WarcError(ValueError):
    """An archive that doesn't follow the format or whose digests don't hold."""


def open_uri(uri: str, write: bool):
    """A stream for a file:// or other URI that pyarrow's file systems know; Hadoop's names for S3 are S3."""
    from pyarrow import fs

    uri = re.sub(r"^s3[an]://", "s3://", uri)
    system, path = fs.FileSystem.from_uri(uri)
    if write:
        system.create_dir(path.rpartition("/")[0], recursive=True)
        return system.open_output_stream(path, compression=None)
    return system.open_input_stream(path, compression=None)


# --- writing --------------------------------------------------------------------


def one_line(value: str) -> str:
    """A header value: line ends and other controls can't occur in one."""
    return "".join(c if c >= " " and c != "\x7f" else " " for c in value)


def record_id(page_id: int | None, digest: str) -> str:
    """The id of a page's record, which a revisit of its payload can name."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None = None) -> bytes:
    """One record as one gzip member. A revisit has the HTTP headers alone as its block, and names the record it revisits."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", one_line(url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("WARC-Refers-To-Date", DATE)]
        if refers_url is not None:
            fields.append(("WARC-Refers-To-Target-URI", one_line(refers_url)))
        fields.append(("X-Refers-To-Page-ID", str(refers_to)))
    fields += [
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head + block + b"\r\n\r\n") + squeeze.flush()


def _write(batches: Iterator[pa.RecordBatch], folder: str, limit: int) -> Iterator[pa.RecordBatch]:
    out, path, size, n = None, "", 0, 0

    def entry() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], ["path", "bytes", "records"])

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for page, url, html, digest, refers, refers_url in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                if out is None:
                    # a name of its own for each attempt: only files in the list that Spark keeps are read
                    path, size, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = open_uri(path, True)
                member = record(page, url, (html or "").encode(), digest, refers, refers_url)
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= limit:
                    out.close()
                    yield entry()
                    out = None
    if out is not None:
        out.close()
        yield entry()


def revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", least: int = MIN_REVISIT, url_col: str = "url") -> DataFrame:
    """__page, __digest, refers_to and refers_url of rows whose payload a row with a smaller id has as well.

    Digests are grouped after a partial aggregation in each task, and small rows
    alone are shuffled, so that a payload of a third of all rows meets in no task.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    keyed = pages.select(
        F.col(id_col).cast("bigint").alias("__page"), F.sha2(payload, 256).alias("__digest"), F.octet_length(payload).alias("__size"), F.col(url_col).cast("string").alias("__url")
    )
    keyed = materialize(keyed.where((F.col("__size") >= least) & F.col("__page").isNotNull()).drop("__size"), "warc-digests")
    first = F.min(F.struct("__page", "__url"))
    shared = keyed.groupBy(F.col("__digest").alias("d")).agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    found = join_counted(keyed.select("__page", "__digest"), shared, "__digest", "d", "n", keyed.count()).where(F.col("__page") > F.col("first.__page"))
    return found.select("__page", "__digest", F.col("first.__page").alias("refers_to"), F.col("first.__url").alias("refers_url")).distinct()


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = MIN_REVISIT,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a WARC record per row, payload ``payload_col`` in UTF-8, and return the archives: path, bytes, records.

    Of rows with equal payloads of at least ``least`` bytes, the one with the smallest
    id becomes a response, the others revisit it. ``folder`` is a URI that all
    executors can write to; by default one in the shared folder, deleted when the driver ends. Files are begun anew
    at ``archive_bytes``. A task that is run again writes files of new names, and those of
    the attempt that Spark counted are listed.

    Null payloads count as empty; a row with a null id is a response without an id; a null url
    is left out; rows that repeat an id and payload are alike; an empty table gives no archive.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = folder or new_path(spark, "warc")
    digest = F.sha2(F.coalesce(F.col(payload_col), F.lit("")).cast("binary"), 256)
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("html"), digest.alias("digest"))
    found = materialize(revisits(pages, id_col, payload_col, least, url_col), "warc-revisits")
    found = F.broadcast(found) if found.count() <= BROADCAST_REVISITS else found
    marked = rows.join(found, (F.col("page_id") == F.col("__page")) & (F.col("digest") == F.col("__digest")), "left")
    marked = marked.select("page_id", "url", "html", "digest", "refers_to", "refers_url")
    written = marked.mapInArrow(lambda batches: _write(batches, folder, archive_bytes), "path string, bytes bigint, records bigint")
    return materialize(written, "warc-list")


# --- reading --------------------------------------------------------------------


class Members:
    """Bytes of a file of gzip members, decompressed as they are asked for, one member at a time."""

    def __init__(self, read: Callable[[int], bytes], at_once: int = READ_BYTES):
        self.read, self.at_once = read, at_once
        self.raw, self.plain, self.engine = b"", b"", None
        self.ended = True

    def next_member(self) -> bool:
        """Begin the next member; False at the end of the file."""
        if not self.ended or self.plain:
            raise WarcError("bytes after the record in its gzip member")
        self.raw = self.raw or self.read(self.at_once)
        if not self.raw:
            return False
        self.engine, self.ended = zlib.decompressobj(31), False
        return True

    def more(self) -> bool:
        """Decompress some more of this member."""
        if self.ended:
            return False
        self.raw = self.raw or self.read(self.at_once)
        if not self.raw:
            raise WarcError("the file ends within a gzip member")
        try:
            self.plain += self.engine.decompress(self.raw, self.at_once)
        except zlib.error as e:
            raise WarcError(f"broken gzip member: {e}") from e
        self.raw = self.engine.unconsumed_tail
        if self.engine.eof:
            self.raw, self.ended = self.engine.unused_data, True
        return True

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (at := self.plain.find(mark, start)) < 0:
            start = max(0, len(self.plain) - len(mark))
            if not self.more():
                raise WarcError("a header without an end")
        found, self.plain = self.plain[: at + len(mark)], self.plain[at + len(mark) :]
        return found

    def parts(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in parts."""
        while n:
            if not self.plain and not self.more():
                raise WarcError("a record shorter than its Content-Length")
            part, self.plain = self.plain[:n], self.plain[n:]
            n -= len(part)
            if part:
                yield part

    def finish(self) -> bytes:
        while self.more():
            pass
        rest, self.plain = self.plain, b""
        return rest


def fields_of(head: bytes) -> dict[str, str]:
    """Fields by name in lower case; of repeated ones the first. Bytes that are no UTF-8 are replaced."""
    lines = re.sub(r"\r\n[ \t]+", " ", head.decode("utf-8", "replace")).split("\r\n")
    found: dict[str, str] = {}
    for name, _, value in (line.partition(":") for line in lines[1:] if line):
        found.setdefault(name.strip().lower(), value.strip())
    return found


class Digest:
    """A digest that a header states, taken over the bytes as they pass; one of an unknown kind always holds."""

    def __init__(self, stated: str | None):
        kind, _, self.stated = (stated or "").partition(":")
        kind = kind.strip().lower().replace("-", "")
        self.state = hashlib.new(kind, usedforsecurity=False) if kind in DIGESTS else None

    def update(self, part: bytes) -> None:
        if self.state:
            self.state.update(part)

    def holds(self) -> bool:
        """Stated in hexadecimal digits, or in base 32 as many crawlers write it."""
        if not self.state:
            return True
        stated = self.stated.strip()
        return stated.lower() == self.state.hexdigest() or stated.upper().rstrip("=") == base64.b32encode(self.state.digest()).decode().rstrip("=")


def number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch("[0-9]+", text) else None


def signed(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch("-?[0-9]+", text) else None


def records(read: Callable[[int], bytes], with_payload: bool = True) -> Iterator[dict]:
    """The records of an archive in turn, each checked against its lengths and the digests it states.

    Yields page_id, url, record_type, payload_bytes, payload_digest, refers_to, record_id, refers_to_record and payload (None
    for a revisit or without ``with_payload``). Of records with HTTP headers the payload is what follows these, of others
    (such as warcinfo and metadata) the whole block. page_id and refers_to are known of this module's own
    archives only. Memory: a part of the file and, if asked for, one payload.
    """
    source = Members(read)
    while source.next_member():
        head = source.until(b"\r\n\r\n")
        if not head.startswith(VERSIONS):
            raise WarcError("not a WARC record")
        head = fields_of(head)
        left, kind = number(head.get("content-length")), head.get("warc-type", "").lower()
        if left is None or not kind:
            raise WarcError("a record without its type or length")
        block, payload, sha256 = Digest(head.get("warc-block-digest")), Digest(head.get("warc-payload-digest")), hashlib.sha256()
        body = not head.get("content-type", "").lower().replace(" ", "").startswith("application/http")
        n, kept, http = 0, [], b""
        for part in source.parts(left):
            block.update(part)
            if not body:
                http += part
                if (at := http.find(b"\r\n\r\n")) < 0:
                    continue
                http, part, body = http[: at + 4], http[at + 4 :], True
            payload.update(part)
            sha256.update(part)
            n += len(part)
            if with_payload:
                kept.append(part)
        if not body and kind == "response":
            raise WarcError("a response without an end of its HTTP headers")
        if source.finish() != b"\r\n\r\n":
            raise WarcError("a record doesn't end with two line ends")
        if not block.holds():
            raise WarcError("block digest doesn't hold")
        said = number(fields_of(http).get("content-length"))
        revisit = kind == "revisit"
        if not revisit and (not payload.holds() or payload.state is None and http and said not in (None, n)):
            raise WarcError("payload digest or length doesn't hold")
        stated = payload.stated.strip().lower() if payload.state and payload.state.name == "sha256" and len(payload.stated.strip()) == 64 else None
        yield {
            "page_id": signed(head.get("x-page-id")), "url": head.get("warc-target-uri"), "record_type": kind, "payload_bytes": said if revisit else n, "payload_digest": stated if revisit else sha256.hexdigest(),
            "refers_to": signed(head.get("x-refers-to-page-id")), "record_id": head.get("warc-record-id"), "refers_to_record": head.get("warc-refers-to"),
            "payload": b"".join(kept) if with_payload and not revisit else None,
        }


RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("refers_to_record", pa.string()), ("payload", pa.binary()),
])


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            held, size = [], 0
            with open_uri(path, False) as stream:
                for r in records(stream.read, with_payload):
                    held.append(r)
                    size += 200 + len(r["payload"] or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, RECORD)
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, RECORD)


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Read archives (column path) back, a row per record.

    Each archive is read from its start to its end by one task: one gzip member a
    record, decompressed a part at a time, cut by content lengths, digests checked;
    what doesn't hold raises WarcError. Archives are dealt out one by one.
    """
    ship(archives.sparkSession)
    paths = archives.select("path")
    dealt = paths.repartition(max(1, min(10_000, paths.count())), "path")
    kinds = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, record_id string, refers_to_record string, payload binary"
    return dealt.mapInArrow(lambda batches: _read(batches, with_payload), kinds)
