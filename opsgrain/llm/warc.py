"""WARC records in ZIP packages: a writer, and a reader that range-reads records without extraction."""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_folder, store

#: Payloads shorter than this are never revisits.
REVISIT_BYTES = 100
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the ZIP format: signatures, sizes, and the marks that send a reader to ZIP64 fields.
LOCAL, CENTRAL, DESCRIPTOR, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x08074B50, 0x06054B50, 0x06064B50, 0x07064B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
#: Bytes that a reader asks for at a time when it looks for the end record; more than the longest comment.
TAIL = 1 << 17
#: Records that lie this close together are read at once, up to so many bytes.
GAP, SPAN = 1 << 16, 8 << 20
#: Entries of an index that a reader passes on at a time.
LISTED = 1 << 16


# --- ZIP packages -----------------------------------------------------------------------


class PackageWriter:
    """Stored (uncompressed) members, written in one pass to a stream that cannot seek; ZIP64 fields throughout."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.members.append({"name": raw, "header": self.at, "crc": 0, "size": 0})
        # bit 3: sizes follow the data; bit 11: UTF-8 name
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x0808, 0, 0, 0x21, 0, FULL32, FULL32, len(raw), len(extra)) + raw + extra)

    def add(self, data: bytes) -> int:
        """Append to the member begun last; gives the place inside it."""
        m = self.members[-1]
        at = m["size"]
        m["crc"], m["size"] = zlib.crc32(data, m["crc"]), at + len(data)
        self._put(data)
        return at

    def end(self) -> None:
        m = self.members[-1]
        self._put(struct.pack("<IIQQ", DESCRIPTOR, m["crc"], m["size"], m["size"]))

    def close(self) -> None:
        start = self.at
        for m in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, m["size"], m["size"], m["header"])
            self._put(
                struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x0808, 0, 0, 0x21, m["crc"], FULL32, FULL32, len(m["name"]), len(extra), 0, 0, 0, 0, FULL32)
                + m["name"] + extra
            )
        size, n, end64 = self.at - start, len(self.members), self.at
        self._put(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, start))
        self._put(struct.pack("<IIQI", LOCATOR64, 0, end64, 1))
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


def directory(read, length: int) -> list[Member]:
    """Members of a package by its central directory; ``read(offset, size)`` gives bytes, ``length`` is that of the file."""
    tail_at = max(0, length - TAIL)
    tail = read(tail_at, length - tail_at)
    at = tail.rfind(struct.pack("<I", END))
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(struct.pack("<I", END), 0, at)  # those bytes may occur in a comment
    if at < 0:
        raise ValueError("no end of central directory")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 == count or FULL32 in (size, start):
        locator = read(tail_at + at - 20, 20)
        if struct.unpack_from("<I", locator)[0] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        record = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if struct.unpack_from("<I", record)[0] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, size, start = struct.unpack_from("<QQQ", record, 32)
    raw, at, out = read(start, size), 0, []
    for _ in range(count):
        if struct.unpack_from("<I", raw, at)[0] != CENTRAL:
            raise ValueError("no central directory header")
        method, = struct.unpack_from("<H", raw, at + 10)
        packed, plain, names, extras, comments = struct.unpack_from("<IIHHH", raw, at + 20)
        header, = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46 : at + 46 + names].decode()
        extra, end = at + 46 + names, at + 46 + names + extras
        while extra + 4 <= end:
            kind, n = struct.unpack_from("<HH", raw, extra)
            if kind == 1:  # only the fields that do not fit above, in this order
                wide = list(struct.unpack_from(f"<{n // 8}Q", raw, extra + 4))
                plain = wide.pop(0) if plain == FULL32 else plain
                packed = wide.pop(0) if packed == FULL32 else packed
                header = wide.pop(0) if header == FULL32 else header
            extra += 4 + n
        out.append(Member(name, method, plain, header))
        at = end + comments
    return out


def data_offset(read, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; it cannot be range-read")
    head = read(member.header, 30)
    signature, = struct.unpack_from("<I", head)
    if signature != LOCAL:
        raise ValueError("no local header")
    names, extras = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + names + extras


# --- WARC records -----------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One response or revisit record; a revisit has the HTTP head only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": "".join((url or "").splitlines()),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        head |= {"WARC-Profile": _REVISIT, "WARC-Refers-To": record_id(refers_to)}
    block = http if revisit else http + payload
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()) + f"Content-Length: {len(block)}\r\n"
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def head_of(raw: bytes) -> tuple[dict[str, str], int]:
    """Headers (lower-case names) of the record that ``raw`` begins with, and where its block begins; ValueError without a whole head."""
    head, blank, _ = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/1.") or not blank:
        raise ValueError("no WARC record")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}, len(head) + 4


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of one record: the block behind its HTTP head, where it has one."""
    headers, begin = head_of(raw)
    block = raw[begin : begin + int(headers["content-length"])]
    if len(block) != int(headers["content-length"]):
        raise ValueError("the record is cut")
    http = headers.get("content-type", "").startswith("application/http")
    return headers, block.partition(b"\r\n\r\n")[2] if http else block


def index_entries(chunks: Iterator[bytes]) -> Iterator[dict]:
    """Entries of an index: lines of JSON, bare or behind key and time; other lines are passed over.  Gzip members are unpacked."""
    rest = b""
    for part in unpacked(chunks):
        *lines, rest = (rest + part).split(b"\n")
        yield from (json.loads(x[x.index(b"{") :]) for x in lines if b'"offset"' in x and b"{" in x)
    yield from (json.loads(x[x.index(b"{") :]) for x in [rest] if b'"offset"' in x and b"{" in x)


def unpacked(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The chunks, or what the gzip members that they make up hold."""
    machine = plain = None
    for chunk in chunks:
        if machine is None and plain is None:
            plain = chunk[:2] != b"\x1f\x8b"
        while chunk:
            if plain:
                yield chunk
                break
            machine = machine or zlib.decompressobj(31)
            yield machine.decompress(chunk)
            chunk = machine.unused_data
            machine = None if machine.eof else machine


def walk(read, begin: int, size: int) -> Iterator[tuple[int, int]]:
    """(place, length) of the records of an archive that no index names: gzip members, or plain records by their heads."""
    at, end = 0, size
    while at < end:
        first = read(begin + at, min(SPAN, end - at))
        start = at
        if first[:2] == b"\x1f\x8b":
            machine, part = zlib.decompressobj(31), first
            while True:
                machine.decompress(part)
                at += len(part) - len(machine.unused_data)
                if machine.eof:
                    break
                if at >= end:
                    raise ValueError("the last record of the archive is cut")
                part = read(begin + at, min(SPAN, end - at))
        else:
            headers, block = head_of(first)
            at += block + int(headers["content-length"]) + 4
            if at > end:
                raise ValueError("the last record of the archive is cut")
        yield start, at - start


def _page(value: str | None) -> int | None:
    """The page of an id of this writer; null for any other."""
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.isascii() and number.isdigit() else None


# --- tables -----------------------------------------------------------------------------


def _resolve(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace(":/", ":///", 1))


@contextmanager
def _opened(uri: str):
    system, path = _resolve(uri)
    with system.open_input_file(path) as f:
        yield (lambda offset, size: f.read_at(size, offset)), f.size()


def write_archives(pages: DataFrame, folder: str | None = None, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) and return the packages (path, records).

    The payload is the html in UTF-8, null as empty.  Of equal payloads of at least ``revisit_bytes`` bytes the record of the smallest
    page_id is a response (rows that repeat that id too) and the others are revisits of it; a null page_id is larger than any number,
    and if all are null, all are responses.  Payloads are compared by digest with a map-side minimum, and joined back to the rows,
    whose side may be split where one payload is very common.

    Each task streams one package with a stored WARC member, whose records are gzip members each, and an index member to ``folder`` (by default a new one in the shared
    folder), so memory is that of one record and the index.  A repeated task writes a package of its own, and only the one of the attempt that
    succeeded is in the result, which is stored.  An empty table writes no package; other columns are not read.
    """
    spark = pages.sparkSession
    target = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long_ones = rows.filter(F.octet_length("payload") >= revisit_bytes)
    first = long_ones.groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first")).filter("n > 1 and first is not null")
    first = store(first.select("digest", "first"), "first")  # a table, so that the rows of a hot payload are split in the join
    rows = rows.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select("page_id", "url", "payload", "digest", "first", revisit.alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        lines: list[str] = []
        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            for row in zip(*columns):
                page_id, url, payload, digest, first, revisit = (v.as_py() for v in row)
                if out is None:
                    uri = f"{target}/{uuid.uuid4().hex}.zip"
                    system, path = _resolve(uri)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(path)
                    package = PackageWriter(out)
                    package.begin(ARCHIVE)
                # a gzip member of its own per record: small on disk, and still read alone
                raw = gzip.compress(record(page_id, url, payload, digest, first, revisit), mtime=0)
                at = package.add(raw)
                lines.append(json.dumps({"page_id": page_id, "filename": ARCHIVE, "offset": at, "length": len(raw)}))
        if out is not None:
            package.end()
            package.begin(INDEX)
            package.add("".join(f"{line}\n" for line in lines).encode())
            package.end()
            package.close()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(lines)], pa.int64())], names=["path", "records"])

    return store(rows.mapInArrow(write, "path string, records bigint"), "packages")


def locate(packages: DataFrame) -> DataFrame:
    """(path, offset, length) of each record of the packages (path), from their directories and index members.

    Index members are those below ``indexes/``; an entry names an archive by its whole name or that below ``archive/``.  An archive that no
    entry names is walked record by record, by the task that reads its package.
    """

    def places(uri: str) -> Iterator[list[tuple[int, int]]]:
        with _opened(uri) as (read, length):
            members = {m.name: m for m in directory(read, length)}
            archives = {n: data_offset(read, m) for n, m in members.items() if n.startswith("archive/") and not n.endswith("/")}
            base = {n.removeprefix("archive/"): (n, at) for n, at in archives.items()} | {n: (n, at) for n, at in archives.items()}
            named: set[str] = set()
            for name, m in members.items():
                if not name.startswith("indexes/") or not m.size:
                    continue
                begin, found = data_offset(read, m), []
                spans = (read(begin + at, min(SPAN, m.size - at)) for at in range(0, m.size, SPAN))
                for x in index_entries(spans):
                    archive, at = base[x["filename"]]
                    named.add(archive)
                    found.append((at + int(x["offset"]), int(x["length"])))
                    if len(found) >= LISTED:
                        yield found
                        found = []
                yield found
            for archive, begin in archives.items():
                if archive not in named:
                    yield [(begin + at, n) for at, n in walk(read, begin, members[archive].size)]

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                for found in places(uri):
                    yield pd.DataFrame({"path": uri, "offset": [at for at, _ in found], "length": [n for _, n in found]}).astype({"offset": "int64", "length": "int64"})

    return packages.select("path").mapInPandas(entries, "path string, offset bigint, length bigint")


def read_records(entries: DataFrame) -> DataFrame:
    """Records at the places (path, offset, length): record_id, page_id, url, record_type, digest, refers_id, refers_to, payload (null for revisits).

    Records may be gzip members or plain.  ids are text as they stand; page_id and refers_to are the numbers of ids that this writer makes.
    Records of a file that lie close together come with one range read; nothing is extracted.  A SHA-256 digest in hex is checked, a record
    with another one, or without, gets that of its payload; revisits keep what they say.
    """
    fields = [
        ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("digest", pa.string()),
        ("refers_id", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ]
    kind = "record_id string, page_id bigint, url string, record_type string, digest string, refers_id string, refers_to bigint, payload binary"
    schema = pa.schema(fields)

    def spans(batch: pd.DataFrame):
        """Runs of neighbouring records of one file."""
        run: list[tuple[int, int]] = []
        uri = None
        for path, offset, length in sorted(zip(batch["path"], batch["offset"], batch["length"])):
            if run and (path != uri or offset > run[-1][0] + run[-1][1] + GAP or offset + length - run[0][0] > SPAN):
                yield uri, run
                run = []
            uri = path
            run.append((offset, length))
        if run:
            yield uri, run

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, run in spans(batch.to_pandas()):
                with _opened(uri) as (read, _):
                    start = run[0][0]
                    raw = read(start, run[-1][0] + run[-1][1] - start)
                rows = []
                for offset, length in run:
                    one = raw[offset - start : offset - start + length]
                    headers, payload = parse(gzip.decompress(one) if one[:2] == b"\x1f\x8b" else one)
                    said, revisit = headers.get("warc-payload-digest"), headers.get("warc-type") == "revisit"
                    digest = said.removeprefix("sha256:") if said else None
                    if not revisit:
                        own = hashlib.sha256(payload).hexdigest()
                        if said and re.fullmatch("sha256:[0-9a-f]{64}", said) and own != digest:
                            raise ValueError(f"{uri}: payload and digest differ at {offset}")
                        digest = own
                    ident, refers = headers.get("warc-record-id"), headers.get("warc-refers-to") if revisit else None
                    rows.append((ident, _page(ident), headers.get("warc-target-uri"), headers.get("warc-type"), digest, refers, _page(refers), None if revisit else payload))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return entries.repartitionByRange("path", "offset").mapInArrow(records, kind)


def read_archives(packages: DataFrame) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest of all records of the packages (path).

    Directories and indexes are read one package per row, the records are then dealt by place over all tasks.  A revisit gets the size
    of the payload it refers to, found by digest; where that response is not in the packages the size is null.
    """
    found = read_records(locate(packages)).withColumn("bytes", F.octet_length("payload").cast("bigint")).drop("payload")
    found = store(found, "records")  # read twice below, the packages once
    sizes = found.filter("record_type = 'response'").groupBy("digest").agg(F.max("bytes").alias("known"))
    out = found.join(store(sizes, "sizes"), "digest", "left")
    return out.select("page_id", "url", "record_type", "refers_to", F.coalesce("bytes", "known").alias("payload_bytes"), F.col("digest").alias("payload_digest"))
