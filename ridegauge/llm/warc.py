"""WARC archives in ZIP packages, written and range-read by Spark.

A package is a ZIP file with two stored (uncompressed) members: ``archive/data.warc.gz``, whose
records are each a gzip member of their own, and ``indexes/index.cdx``, with one line per record
that gives its place in the archive.  Sizes and places are written as ZIP64.  Packages are rows of
bytes that Spark's own writer puts into files, one row a file, so any file system Spark knows will
do; the line end that writer adds is the ZIP comment.

The reader lists the packages without their content.  A task per package finds the end record, follows
the ZIP64 locator where there is one, and reads the central directory and the index, all by ranges.  The
places of records, in spans of about ``SPAN`` bytes, are dealt evenly over tasks, which read just these
ranges; so one large package is many tasks' work and no package is ever in memory as a whole.  Nothing is
extracted.  Ranges are read through Arrow's file systems; where these cannot open a package and only
Spark can, each package is read whole into its task and its records are cut out there.

Null payloads are empty.  Of rows with equal payloads of at least ``least`` bytes the one with the
smallest ``page_id`` is a response, the others are revisits of it without a payload; rows with that
same ``page_id`` are responses too.  Where all of them lack a ``page_id``, all are responses.  Payloads of any
length are stored whole.  No rows give no packages and read back as none.  Only the id, the URL and the page are read,
so other columns may have any name.
"""

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegauge.llm.common import whole
from ridegauge.session import work_folder, written

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
_WIDE, _WIDE16 = 0xFFFFFFFF, 0xFFFF
_COMMENT = b"\n"
SPAN = 1 << 20
SPANS_PER_TASK = 64


# --- ZIP ---------------------------------------------------------------------------------


def stored_zip(members: list[tuple[str, bytes]], zip64: bool = True, comment: bytes = _COMMENT) -> bytes:
    """A ZIP file of stored members, without the bytes of its comment."""
    out, central = io.BytesIO(), []
    for name, data in members:
        raw, crc, place, size = name.encode(), zlib.crc32(data), out.tell(), len(data)
        wide = struct.pack("<HHQQ", 1, 16, size, size) if zip64 else b""
        short = _WIDE if zip64 else size
        head = (45 if zip64 else 20, 0x800, 0, 0, 33, crc, short, short, len(raw))
        out.write(struct.pack("<4s5H3L2H", b"PK\3\4", *head, len(wide)) + raw + wide)
        out.write(data)
        if zip64:
            wide = struct.pack("<HHQQQ", 1, 24, size, size, place)
        central.append(
            struct.pack("<4s6H3L5H2L", b"PK\1\2", 45, *head, len(wide), 0, 0, 0, 0, _WIDE if zip64 else place)
            + raw + wide
        )
    start, listing = out.tell(), b"".join(central)
    out.write(listing)
    many = len(members)
    if zip64:
        end = out.tell()
        out.write(struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, many, many, len(listing), start))
        out.write(struct.pack("<4sLQL", b"PK\6\7", 0, end, 1))
        many, start, size = _WIDE16, _WIDE, _WIDE
    else:
        size = len(listing)
    out.write(struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, many, many, size, start, len(comment)))
    return out.getvalue()


def directory(read, size: int) -> dict[str, tuple[int, int]]:
    """Where each stored member's bytes are: name to (place, length).

    ``read(place, length)`` returns a range of the file.  Handles ZIP64 and comments; a member that
    is not stored is left out, as its records cannot be cut out by their places.
    """
    tail_at = max(0, size - 22 - 65_535)
    tail = bytes(read(tail_at, size - tail_at))
    end = tail.rfind(b"PK\5\6")
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(b"PK\5\6", 0, end)
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    many, length, start = struct.unpack_from("<H2L", tail, end + 10)
    if _WIDE16 == many or _WIDE in (length, start):
        at = tail_at + end - 20
        locator = bytes(read(at, 20)) if at >= 0 else b""
        if locator[:4] != b"PK\6\7":
            raise ValueError("ZIP64 sizes without their locator")
        wide = bytes(read(struct.unpack_from("<Q", locator, 8)[0], 56))
        if wide[:4] != b"PK\6\6":
            raise ValueError("ZIP64 end record is not where its locator says")
        many, length, start = struct.unpack_from("<3Q", wide, 32)
    listing, at, found = bytes(read(start, length)), 0, {}
    for _ in range(many):
        if listing[at : at + 4] != b"PK\1\2":
            raise ValueError("central directory ends early")
        method, = struct.unpack_from("<H", listing, at + 10)
        packed, plain, name_size, extra_size, comment_size = struct.unpack_from("<2L3H", listing, at + 20)
        place, = struct.unpack_from("<L", listing, at + 42)
        name = listing[at + 46 : at + 46 + name_size].decode()
        extra = listing[at + 46 + name_size : at + 46 + name_size + extra_size]
        packed, place = _wide(extra, plain, packed, place)
        at += 46 + name_size + extra_size + comment_size
        if method == 0:
            local = bytes(read(place, 30))
            if local[:4] != b"PK\3\4":
                raise ValueError(f"no local header of {name}")
            found[name] = (place + 30 + sum(struct.unpack_from("<2H", local, 26)), packed)
    return found


def _wide(extra: bytes, plain: int, packed: int, place: int) -> tuple[int, int]:
    """Length and place, from the ZIP64 field where the short ones are full; it lists only those."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            if plain == _WIDE:
                next(values)
            if packed == _WIDE:
                packed = next(values)
            if place == _WIDE:
                place = next(values)
        at += 4 + size
    return packed, place


# --- WARC --------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, kind: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed."""
    line = (url or "").replace("\r", " ").replace("\n", " ")
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Target-URI", line), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if kind == "revisit":
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
        ]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if kind == "response":
        body += payload
    fields.append(("Content-Length", str(len(body))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload (what follows the HTTP header) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def _number(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def marked(pages: DataFrame, least: int = 100) -> DataFrame:
    """``page_id, url, html`` with ``digest``, ``record_type`` and ``refers_to``.

    The first page of a payload is an aggregate over payloads; pages meet it in a join that a payload
    with very many copies does not hold up, as skewed joins are split.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", whole("html").alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    large = F.octet_length("html") >= least
    first = (
        rows.filter(large).groupBy(F.col("digest").alias("of"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("of", "first")
    )
    joined = rows.join(first, F.col("digest") == F.col("of"), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "html", "digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def _packages(rows: DataFrame, most: int) -> DataFrame:
    """A column of packages of about ``most`` bytes; a record larger than that is alone in its own."""
    def pack(batches):
        data, index = io.BytesIO(), []

        def package():
            members = [(DATA, data.getvalue()), (INDEX, "".join(index).encode())]
            return pa.RecordBatch.from_arrays([pa.array([stored_zip(members)], pa.binary())], names=["package"])

        for batch in batches:
            for page_id, url, html, digest, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                plain = record(page_id, url, kind, html.encode(), digest, refers_to)
                press = zlib.compressobj(1, zlib.DEFLATED, 31)
                packed = press.compress(plain) + press.flush()
                index.append(f"{'-' if page_id is None else page_id} {kind} {data.tell()} {len(packed)}\n")
                data.write(packed)
                if data.tell() >= most:
                    yield package()
                    data, index = io.BytesIO(), []
        if index:
            yield package()

    return rows.select("page_id", "url", "html", "digest", "record_type", "refers_to").mapInArrow(
        pack, "package binary"
    )


def write(pages: DataFrame, folder: str, most: int = 4 << 20) -> None:
    """Pages as packages in ``folder``, one per file."""
    _packages(marked(pages), most).select(F.col("package").cast("string")).write.option(
        "maxRecordsPerFile", 1
    ).option("lineSep", _COMMENT.decode()).option("compression", "none").text(folder)


_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
])
_COLUMNS = (
    "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, "
    "payload_digest string"
)


def opened(path: str) -> pa.NativeFile:
    """A package for reading by ranges, from the path that Spark lists."""
    uri = path.replace("file:/", "file:///", 1) if re.match("file:/[^/]", path) else path
    files, place = fs.FileSystem.from_uri(uri)
    return files.open_input_file(place)


def _opens(path: str) -> bool:
    try:
        opened(path).close()
    except (OSError, ValueError, NotImplementedError):  # Arrow's own errors are kinds of these
        return False
    return True


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the packages in ``folder``: its ``page_id, url, record_type, refers_to,
    payload, payload_bytes, payload_digest``; a revisit has no payload, but its length and digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    packages = files.select("path", "length").filter("length > 0")
    first = packages.first()
    if first is None:
        return spark.createDataFrame([], _COLUMNS)
    if not _opens(first["path"]):
        return _read_whole(files)

    def spans(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(*(column.to_pylist() for column in batch.columns)):
                with opened(path) as file:
                    found = list(_spans(lambda at, many: file.read_at(many, at), size))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found)), pa.array([at for at, _ in found], pa.int64()),
                     pa.array([lengths for _, lengths in found], pa.list_(pa.int64()))],
                    names=["path", "at", "lengths"],
                )

    def records(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, lengths in zip(*(column.to_pylist() for column in batch.columns)):
                with opened(path) as file:
                    packed = memoryview(file.read_at(sum(lengths), at))
                rows, start = [], 0
                for length in lengths:
                    rows.append(_record(packed[start : start + length]))
                    start += length
                yield _batch(rows, _SCHEMA)

    placed = written(packages.mapInArrow(spans, "path string, at long, lengths array<long>"), "spans")
    tasks = max(spark.sparkContext.defaultParallelism, placed.count() // SPANS_PER_TASK)
    return placed.repartition(tasks).mapInArrow(records, _COLUMNS)


def _read_whole(files: DataFrame) -> DataFrame:
    def records(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                package = memoryview(content.as_buffer())
                for at, lengths in _spans(lambda at, many: package[at : at + many], len(package)):
                    rows = []
                    for length in lengths:
                        rows.append(_record(package[at : at + length]))
                        at += length
                    yield _batch(rows, _SCHEMA)

    return files.select("content").mapInArrow(records, _COLUMNS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema
    )


def _spans(read_range, size: int) -> Iterator[tuple[int, list[int]]]:
    """Where spans of records of one package start, and the lengths of the records in each."""
    places = directory(read_range, size)
    start, at, lengths = places[DATA][0], 0, []
    for line in bytes(read_range(*places[INDEX])).decode().splitlines():
        place, length = map(int, line.split(" ")[2:])
        if lengths and (place != at + sum(lengths) or sum(lengths) + length > SPAN):
            yield start + at, lengths
            lengths = []
        at = at if lengths else place
        lengths.append(length)
    if lengths:
        yield start + at, lengths


def _record(packed) -> tuple:
    fields, payload = parsed(zlib.decompress(packed, 31))
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "revisit":
        payload, many = None, int(fields["X-Payload-Length"])
    else:
        many = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return (
        _number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], kind,
        _number(fields.get("WARC-Refers-To")), payload, many, digest,
    )


def written_and_read(pages: DataFrame) -> DataFrame:
    """Pages through packages in the shared work folder and back."""
    folder = work_folder(pages.sparkSession, "packages")
    write(pages, folder)
    return read(pages.sparkSession, folder)
