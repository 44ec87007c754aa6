"""Web archives in ZIP packages: written by tasks, and read record by record through their directories.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj`` (a line with the byte
range of each record), both stored, not compressed again. A reader parses the end record, the ZIP64 records if there
are any, and the central directory, finds the stored members, reads the index, and then reads byte ranges of records:
nothing is extracted and no package is read whole by one task.
"""

from __future__ import annotations

import hashlib
import json
import struct
import sys
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.llm.common import partitions
from netvigil.llm.files import Ranges, located, make_folder, publish
from netvigil.session import new_path, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Payloads shorter than this are never revisits. Payload bytes of a package, and record bytes of a read.
SHORT, PACKAGE, READ = 1000, 64 << 20, 4 << 20
WARC, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


# --- ZIP directories ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    start: int
    size: int


def members(file: Ranges) -> list[Member]:
    """The members of a ZIP package, from its central directory; ``start`` is that of the local header."""
    tail_size = min(file.size, 65_557)
    tail = file.read(file.size - tail_size, tail_size)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + (int.from_bytes(tail[at + 20 : at + 22], "little") if at + 22 <= len(tail) else 1 << 20) > len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of a central directory: not a ZIP package, or cut off")
    disk, first, _, count, size, start = struct.unpack("<HHHHII", tail[at + 4 : at + 20])
    end = file.size - tail_size + at
    if 0xFFFF in (disk, first, count) or 0xFFFFFFFF in (size, start):
        if end < 20 or (locator := file.read(end - 20, 20))[:4] != b"PK\x06\x07":
            raise ValueError("the ZIP64 locator is missing")
        record = file.read(struct.unpack("<Q", locator[8:16])[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end record is missing")
        count, size, start = struct.unpack("<QQQ", record[32:56])
    directory, out, at = file.read(start, size), [], 0
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack("<HH", directory[at + 8 : at + 12])
        packed, plain, name_size, extra_size, note_size = struct.unpack("<IIHHH", directory[at + 20 : at + 34])
        place = struct.unpack("<I", directory[at + 42 : at + 46])[0]
        name = directory[at + 46 : at + 46 + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + name_size : at + 46 + name_size + extra_size]
        at += 46 + name_size + extra_size + note_size
        while len(extra) >= 4:
            tag, length = struct.unpack("<HH", extra[:4])
            if tag == 1:
                # The 64-bit values of the fields that are full, in this order.
                wide = iter(struct.unpack(f"<{length // 8}Q", extra[4 : 4 + length // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                place = next(wide) if place == 0xFFFFFFFF else place
            extra = extra[4 + length :]
        out.append(Member(name, method | (flags & 1) << 16, place, packed))
    return out


def data_start(file: Ranges, member: Member) -> int:
    """Where the bytes of a stored member start: behind its local header, whose extra field has its own length."""
    if member.method:
        raise ValueError(f"{member.name} is not a stored member")
    header = file.read(member.start, 30)
    if header[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header for {member.name}")
    return member.start + 30 + sum(struct.unpack("<HH", header[26:30]))


def record_ranges(file: Ranges) -> Iterator[tuple[int, int]]:
    """(start, length) in the package of every archive record: from the indexes, or by a scan of members without one."""
    found = {m.name: m for m in members(file)}
    indexed: dict[str, list[tuple[int, int]]] = {}
    for name, member in found.items():
        if name.startswith("indexes/") and name.endswith(".cdxj"):
            data = file.read(data_start(file, member), member.size)
            for line in data.decode().splitlines():
                entry = json.loads(line[line.index("{") :])
                indexed.setdefault(entry["filename"], []).append((int(entry["offset"]), int(entry["length"])))
    for name, member in found.items():
        if name.startswith("archive/") and name.endswith((".warc", ".warc.gz")):
            start = data_start(file, member)
            own = indexed.get(name, indexed.get(name.rpartition("/")[2]))
            for offset, length in own if own is not None else _scanned(file, start, member):
                if offset + length > member.size:
                    raise ValueError(f"the index of {name} points behind its end")
                yield start + offset, length


def _scanned(file: Ranges, start: int, member: Member) -> Iterator[tuple[int, int]]:
    """Ranges of the gzip members of an archive without an index, read in pieces."""
    if not member.name.endswith(".gz"):
        raise ValueError(f"{member.name} has neither an index nor compressed records")
    first = at = 0
    inflate = zlib.decompressobj(31)
    while at < member.size:
        piece = file.read(start + at, min(1 << 20, member.size - at))
        at += len(piece)
        while piece:
            inflate.decompress(piece)
            piece = inflate.unused_data
            if inflate.eof:
                after = at - len(piece)
                yield first, after - first
                first, inflate = after, zlib.decompressobj(31)


# --- records -----------------------------------------------------------------------------------------------------


def _record(kind: str, page: int | None, refers: int | None, url: str | None, digest: str, size: int, payload: bytes) -> bytes:
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    clean = (url or "").encode("unicode_escape").decode().replace(" ", "%20")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page)}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record, compressed or not."""
    if data[:2] == b"\x1f\x8b":
        data = zlib.decompress(data, 31)
    head, sep, rest = data.partition(b"\r\n\r\n")
    first, *fields = head.decode().split("\r\n")
    if not first.startswith("WARC/") or not sep:
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (f.partition(":") for f in fields)}
    size = int(headers["content-length"])
    if len(rest) < size:
        raise ValueError("the record is cut off")
    return headers, rest[:size]


def _package(folder: str, name: str, rows: list[tuple]) -> tuple[str, int, int]:
    """Writes one package; (path, records, bytes)."""
    path = f"{folder}/{name}.wacz"

    def write(out) -> None:
        index, offset = [], 0
        # Directory fields are 64 bits wide from the start, so a package may grow beyond 4 GiB.
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
            with package.open(WARC, "w", force_zip64=True) as member:
                for kind, page, refers, url, digest, size, payload in rows:
                    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
                    data = squeeze.compress(_record(kind, page, refers, url, digest, size, payload)) + squeeze.flush()
                    member.write(data)
                    index.append(f"{len(index)} " + json.dumps({"filename": WARC, "offset": offset, "length": len(data)}))
                    offset += len(data)
            package.writestr(INDEX, "".join(line + "\n" for line in index))

    return path, len(rows), publish(path, write)


def _writer(folder: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            # A repeated task writes under new names; only the rows of the one that counts reach the manifest.
            path, count, length = _package(folder, uuid.uuid4().hex, held)
            return pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([count], pa.int64()), pa.array([length], pa.int64())], names=["path", "records", "bytes"]
            )

        for batch in batches:
            columns = [batch.column(i) for i in range(7)]
            for at in range(batch.num_rows):
                kind, page, refers, url, digest, length, html = (c[at].as_py() for c in columns)
                payload = b"" if kind == "revisit" else (html or "").encode()
                held.append((kind, page, refers, url, digest, length, payload))
                size += len(payload) + 300
                if size >= PACKAGE:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return rows


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for every row of ``pages`` (page_id, url, html) into packages below ``folder``; the manifest
    (path, records, bytes), read from where it was stored.

    Of equal payloads of at least ``SHORT`` bytes the record with the largest page_id is the response and the others
    revisit it (rows without page_id too; where all lack it, all are responses). Rows that share the largest page_id
    are all responses. Null html is an empty payload, null urls are empty; further columns are ignored.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    digest, size = F.sha1(F.col("html").cast("binary")), F.octet_length("html").cast("long")
    payloads = rows.select("page_id", digest.alias("same"), size.alias("size")).where(F.col("size") >= SHORT)
    repeated = payloads.groupBy("same").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = stored(repeated.where("n > 1 AND first IS NOT NULL").select("same", "first"), "repeated-payloads")
    joined = rows.withColumn("digest", digest).withColumn("size", size)
    joined = joined.join(repeated, F.col("digest") == F.col("same"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    make_folder(folder)
    return stored(joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("kind"), "page_id", F.when(revisit, F.col("first")).alias("refers_to"),
        "url", "digest", "size", "html",
    ).mapInArrow(_writer(folder), "path string, records long, bytes long"), "packages")


def _plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of records that follow each other, of about ``READ`` bytes, from each package's directories."""
    for batch in batches:
        for path in batch["path"]:
            paths, starts, lengths, held = [], [], [], 0
            with Ranges(path) as file:
                for start, length in record_ranges(file):
                    if not starts or held + length > READ:
                        paths.append(path)
                        starts.append([])
                        lengths.append([])
                        held = 0
                    starts[-1].append(start)
                    lengths[-1].append(length)
                    held += length
                    if len(paths) == 64:
                        yield pd.DataFrame({"path": paths[:-1], "starts": starts[:-1], "lengths": lengths[:-1]})
                        paths, starts, lengths = paths[-1:], starts[-1:], lengths[-1:]
            if paths:
                yield pd.DataFrame({"path": paths, "starts": starts, "lengths": lengths})


_RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _reader(with_payload: bool):
    def number(name: str | None) -> int | None:
        text = (name or "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, starts, lengths in zip(batch["path"], batch["starts"], batch["lengths"]):
                out = []
                with Ranges(path) as file:
                    at = 0
                    while at < len(starts):
                        to = at + 1
                        while to < len(starts) and starts[to] == starts[to - 1] + lengths[to - 1]:
                            to += 1
                        data = file.read(int(starts[at]), int(starts[to - 1] + lengths[to - 1] - starts[at]))
                        for k in range(at, to):
                            lo = int(starts[k] - starts[at])
                            head, payload = parse_record(data[lo : lo + int(lengths[k])])
                            kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
                            size = int(head["x-payload-length"])
                            if kind == "response":
                                if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
                                    raise ValueError(f"a payload in {path} isn't what its record says")
                            url = head["warc-target-uri"].encode().decode("unicode_escape")
                            out.append((
                                number(head["warc-record-id"]), url, size, digest, kind, number(head.get("warc-refers-to")),
                                payload if with_payload and kind == "response" else None,
                            ))
                        at = to
                frame = pd.DataFrame(out, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    return rows


def read_packages(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the packages named by ``path`` in ``manifest``: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and, of responses, the payload.

    Payload length and digest of a response are checked against its bytes; a revisit's come from its headers. One task
    parses the directories of a package; its records are then read by range, in runs of bounded size, by any task.
    """
    width = partitions(manifest)
    runs = manifest.select("path").repartition(width).mapInPandas(_plan, "path string, starts array<long>, lengths array<long>")
    return runs.repartition(width).mapInPandas(_reader(with_payload), _RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every row of ``pages``, written to packages in
    the shared folder and read back from them. Null html is the empty payload, payloads of any length are written whole, repeated
    rows have a record each, further columns are ignored, and an empty table gives no rows."""
    spark: SparkSession = pages.sparkSession
    manifest = write_packages(pages, new_path(spark, "archives"))
    return read_packages(manifest, with_payload=False).drop("payload", "url")


def exists(uri: str) -> bool:
    system, path = located(uri)
    return system.get_file_info(path).type.name == "File"


ARCHIVE_SQL = f"""
WITH paid AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
made AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM paid),
firsts AS (SELECT *, CASE WHEN payload_bytes >= {SHORT} THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM made)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first <> page_id OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id OR (page_id IS NULL AND first IS NOT NULL) THEN first END AS refers_to
FROM firsts
"""
