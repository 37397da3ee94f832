"""WARC records in ZIP-packaged archives: written in parts, read back by byte ranges without extraction."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendreach.llm.common import map_arrow
from lendreach.session import cut_lineage, fresh_path

ARCHIVE_BYTES = 64 << 20    # packed records after which a new archive is begun
BLOCK_BYTES = 4 << 20       # neighbouring records that one range-read fetches
DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
# fixed signatures of the ZIP format
LOCAL, CENTRAL, END, END64, LOCATOR = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
FULL32 = 0xFFFFFFFF


def opened(path: str):
    """(file system, path) of a URI; a bare path is a local or mounted one."""
    return FileSystem.from_uri(path if "://" in path or path.startswith("file:/") else f"file://{path}")


# ---- writing ---------------------------------------------------------------------------------------

class ZipWriter:
    """Stored members only, every size in ZIP64 fields, written front to back."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def store(self, name: str, chunks: list[bytes]) -> None:
        raw, size, crc, begin = name.encode(), sum(map(len, chunks)), 0, self.at
        for c in chunks:
            crc = zlib.crc32(c, crc)
        extra = struct.pack("<HHQQ", 1, 16, size, size)
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x800, 0, 0, 33, crc, FULL32, FULL32, len(raw), len(extra))
                  + raw + extra)
        for c in chunks:
            self._put(c)
        self.members.append((raw, size, crc, begin))

    def finish(self) -> int:
        begin = self.at
        for raw, size, crc, at in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x800, 0, 0, 33, crc, FULL32, FULL32,
                                  len(raw), len(extra), 0, 0, 0, 0, FULL32) + raw + extra)
        size, at, n = self.at - begin, self.at, len(self.members)
        self._put(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, begin))
        self._put(struct.pack("<IIQI", LOCATOR, 0, at, 1))
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, 0xFFFF, 0xFFFF, FULL32, FULL32, 0))
        return self.at


def record(page_id: int, url: str | None, html: str | None, digest: str, size: int, refers: int | None) -> bytes:
    """One WARC record as a gzip member; a revisit has no payload but names the record that has it."""
    kind = "response" if refers is None else "revisit"
    payload = (html or "").encode() if refers is None else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page_id}>"),
            ("WARC-Target-URI", " ".join((url or "").split())),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size)),
            ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if refers is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers}>"),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(text.encode() + block + b"\r\n\r\n") + pack.flush()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page as a record and return the manifest (path, records, bytes), itself stored.

    Equal payloads (by SHA-1) have one response, that of the largest page_id; the others revisit it. A null
    html is the empty payload, and empty payloads are deduplicated like any other. Repeated page ids with equal
    html are one revisiting-free group: each is a response of its own. Rows with a null page_id are left out.
    Archives are named anew by every attempt of a task, so only those in the manifest count.
    """
    rows = pages.filter("page_id is not null").select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"sha1": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html")})
    owners = (rows.groupBy("sha1").agg(F.max("page_id").alias("owner"), F.min("page_id").alias("least"))
              .filter("owner > least").drop("least"))
    rows = rows.join(owners, "sha1", "left")

    def put(batches):
        chunks, index, at = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal chunks, index, at
            path = f"{folder}/pages-{uuid.uuid4().hex}.wacz"
            fs, local = opened(path)
            fs.create_dir(local.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(local, compression=None) as out:
                z = ZipWriter(out)
                z.store(DATA, chunks)
                z.store(INDEX, [b"".join(json.dumps(x).encode() + b"\n" for x in index)])
                size = z.finish()
            done = pa.RecordBatch.from_pylist([{"path": path, "records": len(index), "bytes": size}], MANIFEST)
            chunks, index, at = [], [], 0
            return done

        for b in batches:
            for r in (r for lo in range(0, len(b), 100) for r in b.slice(lo, 100).to_pylist()):
                digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                refers = r["owner"] if r["owner"] is not None and r["owner"] != r["page_id"] else None
                data = record(r["page_id"], r["url"], r["html"], digest, r["size"], refers)
                chunks.append(data)
                index.append([r["page_id"], at, len(data)])
                at += len(data)
                if at >= archive_bytes:
                    yield close()
        if index:
            yield close()

    named = rows.select("page_id", "url", "html", "sha1", "size", "owner")
    return cut_lineage(map_arrow(named, put, "path string, records long, bytes long"), "warc-manifest")


MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


# ---- reading ---------------------------------------------------------------------------------------

def members(file, size: int) -> dict[str, tuple[int, int]]:
    """(first byte, length) of every stored member, from the central directory; ZIP64 fields count.

    Only the tail of the file, the directory and the members' own headers are read.
    """
    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    tail = read(max(0, size - 66_000), min(size, 66_000))
    spot = tail.rfind(struct.pack("<I", END))
    if spot < 0:
        raise ValueError("no end of central directory")
    end = max(0, size - 66_000) + spot
    _, _, _, _, count, length, begin, _ = struct.unpack("<IHHHHIIH", tail[spot:spot + 22])
    if (count == 0xFFFF or FULL32 in (length, begin)) and end >= 20:
        sign, _, at, _ = struct.unpack("<IIQI", read(end - 20, 20))
        if sign == LOCATOR:
            sign, _, _, _, _, _, _, count, length, begin = struct.unpack("<IQHHIIQQQQ", read(at, 56))
            if sign != END64:
                raise ValueError("broken ZIP64 directory")
    directory, out, p = read(begin, length), {}, 0
    for _ in range(count):
        f = struct.unpack("<IHHHHHHIIIHHHHHII", directory[p:p + 46])
        if f[0] != CENTRAL:
            raise ValueError("broken central directory")
        packed, full, at = f[8], f[9], f[16]
        name = directory[p + 46:p + 46 + f[10]].decode()
        extra, e = directory[p + 46 + f[10]:p + 46 + f[10] + f[11]], 0
        while e + 4 <= len(extra):
            tag, n = struct.unpack("<HH", extra[e:e + 4])
            if tag == 1:        # holds only the fields that are full, in this order
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[e + 4:e + 4 + n // 8 * 8]))
                full = next(wide) if full == FULL32 else full
                packed = next(wide) if packed == FULL32 else packed
                at = next(wide) if at == FULL32 else at
            e += 4 + n
        p += 46 + f[10] + f[11] + f[12]
        if f[4] == 0:           # stored
            head = struct.unpack("<IHHHHHIIIHH", read(at, 30))
            if head[0] != LOCAL:
                raise ValueError("broken local header")
            out[name] = (at + 30 + head[9] + head[10], packed)
    return out


def _blocks(path: str, block_bytes: int) -> Iterator[dict]:
    fs, local = opened(path)
    size = fs.get_file_info(local).size
    with fs.open_input_file(local) as f:
        at = members(f, size)
        base, (lo, n) = at[DATA][0], at[INDEX]
        f.seek(lo)
        begin, sizes = 0, []
        for line in f.read(n).splitlines():
            _, start, length = json.loads(line)
            if sizes and start + length - begin > block_bytes:
                yield {"path": path, "at": base + begin, "sizes": sizes}
                sizes = []
            begin = begin if sizes else start
            sizes.append(length)
        if sizes:
            yield {"path": path, "at": base + begin, "sizes": sizes}


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one unpacked record."""
    head, _, block = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = block[:int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def read_archives(manifest: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every record of the archives: page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload.

    Directories and indexes are read first, one task an archive; the byte ranges they name are then dealt out
    and read by themselves. A response's digest is checked against its payload and a mismatch is an error; a
    revisit (null payload) carries the digest and length of the payload it refers to.
    """
    def plan(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                yield pa.RecordBatch.from_pylist(list(_blocks(path, block_bytes)), BLOCKS)

    def fetch(batches):
        for b in batches:
            for x in b.to_pylist():
                fs, local = opened(x["path"])
                with fs.open_input_file(local) as f:
                    f.seek(x["at"])
                    data = memoryview(f.read(sum(x["sizes"])))
                rows, at = [], 0
                for n in x["sizes"]:
                    rows.append(_row(*parse(zlib.decompress(data[at:at + n], 31))))
                    at += n
                yield pa.RecordBatch.from_pylist(rows, RECORDS)

    ranges = map_arrow(manifest.select("path"), plan, "path string, at long, sizes array<long>")
    spark = manifest.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return map_arrow(ranges.repartition(parts), fetch,
                     "page_id long, url string, record_type string, refers_to long, payload_digest string, "
                     "payload_bytes long, payload binary")


def _row(fields: dict[str, str], payload: bytes) -> dict:
    def number(name: str) -> int | None:
        return int(fields[name].rpartition(":")[2].rstrip(">")) if name in fields else None

    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    size = int(fields["X-Payload-Length"])
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != size:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {"page_id": number("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "record_type": kind,
            "refers_to": number("WARC-Refers-To"), "payload_digest": digest, "payload_bytes": size,
            "payload": payload if kind == "response" else None}


BLOCKS = pa.schema([("path", pa.string()), ("at", pa.int64()), ("sizes", pa.list_(pa.int64()))])
RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload", pa.binary())])


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages into archives in the shared folder and read the records back."""
    return read_archives(write_archives(pages, fresh_path(pages.sparkSession, "warc")))
