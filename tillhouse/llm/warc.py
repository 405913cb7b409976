"""WARC archives: written by tasks, read back by a sequential reader.

Every record is a gzip member of its own. The reader takes a file in blocks, inflates member after
member through one incremental decompressor, frames records by Content-Length, and verifies the
digests of block and payload while they pass, by the algorithm (SHA-1, SHA-256, SHA-512, MD5) and the
encoding (base32 or hex) that the record names. Neither side holds more than one record.

All record types of other archives are read. The payload of HTTP requests and responses is what follows
their head, with chunks put together; that of other records is their block. Digests, HTTP lengths and
target URIs may be missing: a payload without a digest gets its SHA-256. A record that is damaged (its
gzip member, head, framing or a digest) stops the reading, or, with `damaged="report"`, is given with
what is wrong with it in `error`, and reading goes on at the next member: no other record is lost.

Records of equal payloads of `REVISIT_BYTES` at least are written once: the smallest page is the
response, the others are revisits that keep headers only. Groups of copies meet as one row per
payload digest, made before the shuffle, and only repeated digests are joined back to the pages.

Archives are written through Arrow's file systems (local, HDFS, S3, GCS by the URI of the folder)
under names of the attempt that writes them. The list of files is itself a table that Spark
commits, so files of failed or repeated attempts are never read.

Defined results: a null payload is empty. Payloads below `REVISIT_BYTES` are always responses.
Rows that share the smallest page_id of a payload are all responses; null page_ids come last, and
where all are null all are responses. Null and unprintable URLs are allowed. An empty table gives
no archive and an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import batch_rows, keep
from tillhouse.operators.joins import splittable_join
from tillhouse.session import shared_dir

REVISIT_BYTES = 100
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 1 << 18
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = (
    "record_type string, record_id string, date string, url string, page_id long, refers_to long, refers_to_uri string, "
    "refers_to_date string, payload_bytes long, digest_algorithm string, payload_digest string, payload binary, error string"
)
RAISE, REPORT = "raise", "report"
DAMAGED = "damaged"


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", content: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, bytes, refers_to, original_url) of every page; refers_to is set for revisits."""
    payload = F.coalesce(F.col(content).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})
    repeated = (
        rows.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.min_by("url", "page_id").alias("original_url"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "original", "original_url")
    )
    met = splittable_join(rows, repeated, "digest", "left")
    differs = F.col("page_id").isNull() | (F.col("page_id") != F.col("original"))
    refers = F.when((F.col("bytes") >= REVISIT_BYTES) & differs, F.col("original"))
    return met.select(
        "page_id", "url", "digest", "bytes", refers.alias("refers_to"), "original_url",
        F.when(refers.isNull(), F.col("payload")).alias("payload"),
    )


def _head(lines: list[tuple[str, str]], first: str) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode()


def _target(url: str | None, page_id: int | None) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"


def _record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{_target(url, page_id)}/{digest}')}>"


def record_bytes(
    page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, payload: bytes | None,
    original_url: str | None = None,
) -> bytes:
    """One record, uncompressed: a response, or without `payload` a revisit of the page `refers_to`."""
    http = _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))], "HTTP/1.1 200 OK")
    block = http + (payload or b"")
    fields = [
        ("WARC-Type", "revisit" if payload is None else "response"),
        ("WARC-Record-ID", _record_id(page_id, url, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _target(url, page_id)),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if payload is None:
        fields += [
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, original_url, digest)),
            ("WARC-Refers-To-Target-URI", _target(original_url, refers_to)), ("WARC-Refers-To-Date", DATE),
            ("Refers-To-Page-ID", str(refers_to)),
        ]
    fields.append(("Content-Length", str(len(block))))
    return _head(fields, "WARC/1.1") + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 6) -> DataFrame:
    """Write `records` rows as archives under `folder`; (file, records, bytes) of every archive.

    A task writes one archive, and begins another when it exceeds `archive_bytes`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, name, done, size = None, "", 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([done], pa.int64()), pa.array([size], pa.int64())], names=["file", "records", "bytes"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, done, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                data = _member(record_bytes(row["page_id"], row["url"], row["digest"], row["bytes"], row["refers_to"], row["payload"], row["original_url"]), level)
                out.write(data)
                done, size = done + 1, size + len(data)
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    with batch_rows(rows.sparkSession, 256):
        return keep(rows.mapInArrow(run, "file string, records long, bytes long"), "warc-files")


class Damaged(ValueError):
    """A record that can not be read as it stands."""


class _Inflated:
    """The bytes of a gzip file of many members, one member after another."""

    MAGIC = b"\x1f\x8b\x08"

    def __init__(self, stream):
        self.stream, self.packed, self.plain = stream, b"", bytearray()
        self.unzip = None
        # What the member took so far, so that it can be searched again if it is damaged.
        self.taken = bytearray()

    def more(self) -> bool:
        """Inflate another piece of the member; False at its end."""
        if self.unzip is None or self.unzip.eof:
            return False
        if not self.packed:
            self.packed = self.stream.read(READ_BYTES)
            if not self.packed:
                raise Damaged("the archive ends inside a member")
        before = self.packed
        try:
            self.plain += self.unzip.decompress(self.packed, READ_BYTES)
        except zlib.error as error:
            raise Damaged(f"a member does not inflate: {error}") from error
        self.packed = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail
        self.taken += before[:len(before) - len(self.packed)]
        return True

    def begin(self) -> bool:
        """Go to the next record, in this member or in the next one; False at the end of the file."""
        if self.plain:
            return True
        if not self.packed:
            self.packed = self.stream.read(READ_BYTES)
        self.unzip, self.taken = zlib.decompressobj(31), bytearray()
        return bool(self.packed)

    def until(self, mark: bytes) -> bytes:
        """What comes before `mark`, which is passed."""
        at = 0
        while (found := self.plain.find(mark, at)) < 0:
            at = max(0, len(self.plain) - len(mark) + 1)
            if not self.more():
                raise Damaged("a header has no end")
        out = bytes(self.plain[:found])
        del self.plain[:found + len(mark)]
        return out

    def pieces(self, size: int) -> Iterator[bytes]:
        """The next `size` bytes, in pieces."""
        while size:
            if not self.plain and not self.more():
                raise Damaged("a member is shorter than its Content-Length")
            piece = bytes(self.plain[:size])
            del self.plain[:len(piece)]
            size -= len(piece)
            yield piece

    def end(self) -> None:
        """Pass the two line ends after a block; what follows them in the member is another record."""
        while len(self.plain) < 9 and self.more():
            pass
        if bytes(self.plain[:4]) != b"\r\n\r\n" or len(self.plain) > 4 and not self.plain.startswith(b"WARC/", 4):
            raise Damaged("a record is longer than its Content-Length")
        del self.plain[:4]

    def skip(self) -> None:
        """Pass what is left of a damaged record: its member if that inflates, else to the next one that does."""
        try:
            while self.more():
                self.plain.clear()
            self.plain.clear()
            return
        except Damaged:
            self.plain.clear()
        left = bytes(self.taken) + self.packed
        at = 1
        while True:
            at = left.find(self.MAGIC, at)
            if at < 0:
                left, at = left[-2:], 0
                more = self.stream.read(READ_BYTES)
                if not more:
                    self.packed, self.taken = b"", bytearray()
                    return
                left += more
                continue
            if len(left) - at < 512:
                left, at = left[at:] + self.stream.read(READ_BYTES), 0
            try:
                if zlib.decompressobj(31).decompress(left[at:at + 4096], 5) in (b"WARC/", b""):
                    self.packed = left[at:]
                    return
            except zlib.error:
                pass
            at += 1


class _Chunks:
    """Takes the chunks of an HTTP body apart while it passes."""

    def __init__(self) -> None:
        self.held, self.left, self.done = bytearray(), 0, False

    def feed(self, piece: bytes) -> bytes:
        self.held += piece
        out = bytearray()
        while not self.done:
            if self.left:
                take = self.held[:self.left]
                out += take
                del self.held[:len(take)]
                self.left -= len(take)
                if self.left:
                    break
            at = self.held.find(b"\r\n", 2 if self.held.startswith(b"\r\n") else 0)
            if at < 0:
                break
            size = bytes(self.held[:at]).strip().split(b";")[0]
            del self.held[:at + 2]
            try:
                self.left = int(size, 16)
            except ValueError as error:
                raise Damaged("a chunk has no size") from error
            self.done = self.left == 0
        return bytes(out)


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with white space goes on with the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        name = name.strip().lower()
        out[name] = value.strip()
    return out


_ALGORITHMS = {"sha1": "sha1", "sha-1": "sha1", "sha256": "sha256", "sha-256": "sha256", "sha512": "sha512", "sha-512": "sha512", "md5": "md5"}


class _Digest:
    """A digest that a field names, computed while bytes pass; without a field, or for an unknown name, SHA-256."""

    def __init__(self, field: str | None):
        name, _, value = (field or "").partition(":")
        self.algorithm = _ALGORITHMS.get(name.strip().lower())
        self.wanted = value.strip() if self.algorithm else None
        self.hash = hashlib.new(self.algorithm or "sha256")
        self.stated = (name.strip().lower(), value.strip()) if field else None

    def update(self, piece: bytes) -> None:
        self.hash.update(piece)

    def holds(self) -> bool:
        if self.wanted is None:
            return True
        size = self.hash.digest_size
        try:
            if len(self.wanted) == 2 * size:
                return bytes.fromhex(self.wanted) == self.hash.digest()
            return base64.b32decode(self.wanted.upper() + "=" * (-len(self.wanted) % 8)) == self.hash.digest()
        except (ValueError, binascii.Error):
            return False


def _number(value: str | None) -> int | None:
    return int(value) if value and value.isdigit() else None


def _signed(value: str | None) -> int | None:
    return -_number(value[1:]) if value and value.startswith("-") else _number(value)


def _record(data: _Inflated, with_payload: bool) -> dict:
    """The next record; `error` says which digest or length does not hold."""
    head = data.until(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise Damaged("a member does not begin with a WARC record")
    fields = _fields(head)
    left = _number(fields.get("content-length"))
    if left is None or "warc-type" not in fields:
        raise Damaged("a record has no type or length")
    kind = fields["warc-type"].lower()
    revisit, is_http = kind == "revisit", "application/http" in fields.get("content-type", "").lower()
    block, raw = _Digest(fields.get("warc-block-digest")), _Digest(fields.get("warc-payload-digest"))
    whole = _Digest(fields.get("warc-payload-digest"))
    http: dict[str, str] | None = None
    chunks: _Chunks | None = None
    begun, kept = bytearray(), []
    got = got_raw = 0
    error = None

    def payload(piece: bytes) -> None:
        nonlocal got, got_raw, error, chunks
        raw.update(piece)
        got_raw += len(piece)
        if chunks is not None:
            try:
                piece = chunks.feed(piece)
            except Damaged as damage:
                error, piece = str(damage), b""
            whole.update(piece)
        got += len(piece)
        if with_payload:
            kept.append(piece)

    for piece in data.pieces(left):
        block.update(piece)
        if is_http and http is None:
            begun += piece
            if (at := begun.find(b"\r\n\r\n")) < 0:
                continue
            http, piece = _fields(bytes(begun[:at])), bytes(begun[at + 4:])
            if "chunked" in http.get("transfer-encoding", "").lower() and not revisit:
                chunks = _Chunks()
        payload(piece)
    data.end()
    if is_http and http is None:
        # A head without an end has no payload.
        http = _fields(bytes(begun))
    length = _number((http or {}).get("content-length"))
    if chunks is None:
        whole = raw
    if not block.holds():
        error = "a block does not have its digest"
    elif not revisit and not raw.holds() and not whole.holds():
        error = "a payload does not have its digest"
    elif kind == "response" and chunks is None and length is not None and length != got:
        error = "a payload does not have its length"
    stated = whole.stated or ("sha256", None if revisit else whole.hash.hexdigest())
    uri = fields.get("warc-target-uri")
    return {
        "record_type": kind,
        "record_id": fields.get("warc-record-id"),
        "date": fields.get("warc-date"),
        "url": uri[1:-1] if uri and uri.startswith("<") and uri.endswith(">") else uri,
        "page_id": _signed(fields.get("page-id")),
        "refers_to": _signed(fields.get("refers-to-page-id")),
        "refers_to_uri": fields.get("warc-refers-to-target-uri"),
        "refers_to_date": fields.get("warc-refers-to-date"),
        "payload_bytes": length if revisit else got,
        "digest_algorithm": stated[0],
        "payload_digest": stated[1],
        "payload": b"".join(kept) if with_payload and not revisit else None,
        "error": error,
    }


def read_records(stream, with_payload: bool = True, damaged: str = RAISE) -> Iterator[dict]:
    """The records of one archive, with the columns of `RECORD_SCHEMA`.

    A damaged one raises `Damaged`, a ValueError, or with `damaged="report"` comes with its `error`; where not
    even its head could be read, its type is `damaged`.
    """
    data = _Inflated(stream)
    while data.begin():
        try:
            record = _record(data, with_payload)
        except Damaged as damage:
            if damaged == RAISE:
                raise
            record = dict.fromkeys(part.split()[0] for part in RECORD_SCHEMA.split(", ")) | {"record_type": DAMAGED, "error": str(damage)}
            data.skip()
        if record["error"] and damaged == RAISE:
            raise Damaged(record["error"])
        yield record


def read_archives(files: DataFrame, folder: str, with_payload: bool = True, damaged: str = RAISE) -> DataFrame:
    """The records of the archives that `files` (file) lists, with the columns of `RECORD_SCHEMA`; one file a task.

    The archives may come from elsewhere: list their names below `folder`. `damaged` as in `read_records`.
    """
    if damaged not in (RAISE, REPORT):
        raise ValueError(f"unknown policy {damaged}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in RECORD_SCHEMA.split(", "))])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:  # the members are inflated here
                    held, size = [], 0
                    for record in read_records(stream, with_payload, damaged):
                        held.append(record)
                        size += 256 + len(record["payload"] or b"")
                        if size >= 1 << 22:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    number = max(1, files.count())
    spread = files.select("file").repartition(number, "file") if number > 1 else files.select("file")
    return spread.mapInArrow(run, RECORD_SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None, with_payload: bool = False) -> DataFrame:
    """Write `pages` (page_id, url, html) as archives and read the records back."""
    folder = folder or shared_dir(spark, "llm-warc")
    files = write_archives(records(pages), folder)
    return read_archives(files, folder, with_payload)
