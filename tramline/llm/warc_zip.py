"""WARC records in ZIP-packaged archives: writing, and reading by range.

An archive is a ZIP file of stored (uncompressed) members: one WARC file of
gzip members, one per record, and an index that gives the place of each.
The reader never extracts: it reads the end of the file, follows the end
record (or the ZIP64 one) to the central directory, finds the members there,
reads the index, and then reads runs of records by byte range. Archives are
listed by Spark, their runs of records dealt over all tasks, so one large
archive is read by many.

Archives are of bounded size; a task that fails leaves a file that no
manifest names. Equal payloads are found by a grouped maximum over digests
(folded before the shuffle) joined back on the digest.

Defined results: a null html is an empty payload; a null url becomes
``urn:page:<id>``; of equal payloads every row with the largest page_id is a
response (so are all, if none has an id) and the others revisit it; repeated
rows each get a record; an empty table gives no archive and an empty table.
Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import python_ready, stored, table
from tramline.session import fresh_dir

#: Bytes of compressed records after which a task starts its next archive.
ARCHIVE_BYTES = 64 << 20
#: Bytes of records that are read by one range request.
RANGE_BYTES = 4 << 20
#: Date written on every record (pages carry none).
DATE = "1970-01-01T00:00:00Z"

MANIFEST = "path string, n_records long"
RANGES = "path string, first long, last long, places binary"
#: Ids pass through pandas as text: long columns with nulls would turn to floats.
RECORDS = ("record_id string, record_type string, target_uri string, page_id string, "
           "refers_to string, payload_bytes long, payload_digest string, payload binary")


# ---------------------------------------------------------------- writing

def _page_urn(page_id) -> str:
    return "urn:page:" + ("" if page_id is None else str(page_id))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id, url: str | None, html: str | None, refers_to) -> bytes:
    """One WARC record, as a gzip member. A revisit carries the HTTP header of
    its response, with the length of the payload it leaves out."""
    payload = (html or "").encode()
    revisit = refers_to is not None
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <{_page_urn(page_id)}>",
             f"WARC-Target-URI: {(url or _page_urn(page_id)).replace(chr(13), '').replace(chr(10), '')}",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{_page_urn(refers_to)}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _open_out(uri: str):
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    if hasattr(system, "create_dir"):
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path)


def _write_archive(folder: str, records: Iterator[tuple[str, bytes]]) -> tuple[str, int]:
    """Write records into one archive until it is full; None when none came."""
    uri, n, at, index = f"{folder}/{uuid.uuid4().hex}.zip", 0, 0, []
    first = next(records, None)
    if first is None:
        return uri, 0
    with _open_out(uri) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, True) as packed:
        with packed.open("archive/data.warc.gz", "w", force_zip64=True) as member:
            record = first
            while record is not None:
                target, raw = record
                member.write(raw)
                index.append(f"{target} {json.dumps({'offset': at, 'length': len(raw)})}\n")
                at += len(raw)
                n += 1
                record = next(records, None) if at < ARCHIVE_BYTES else None
        packed.writestr("indexes/index.cdxj", "".join(index).encode())
    return uri, n


def archive_rows(pages: DataFrame) -> DataFrame:
    """page_id, url, html and refers_to (null for responses)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                        F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"))
    classes = (rows.groupBy("digest").agg(F.max("page_id").alias("top"),
                                          F.count("*").alias("n"))
               .where("n > 1").select("digest", "top"))
    return (rows.join(classes, "digest", "left")
            .select("page_id", "url", "html", F.when(
                F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")),
                F.col("top")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per row of ``pages`` into archives under ``folder``
    (shared storage); the manifest of the archives written."""
    python_ready(pages)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records():
            for batch in batches:
                for page, url, html, to in zip(*(batch[c] for c in
                                                 ("page_id", "url", "html", "refers_to"))):
                    yield _page_urn(page), warc_record(page, url, html, to)
        source = records()
        while True:
            uri, n = _write_archive(folder, source)
            if not n:
                return
            yield pd.DataFrame({"path": [uri], "n_records": [n]})

    rows = archive_rows(pages).withColumns(
        {c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return stored(rows.mapInPandas(run, MANIFEST), "warc-manifest")


# ---------------------------------------------------------------- reading

class RangeReader:
    """Bytes of a stored file by range."""

    def __init__(self, uri: str):
        from pyarrow import fs
        system, path = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        self.size = self.file.size()

    def __enter__(self) -> RangeReader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def read(self, first: int, length: int) -> bytes:
        got = self.file.read_at(length, first)
        if len(got) != length:
            raise ValueError(f"{length} bytes asked for at {first}, {len(got)} there")
        return got


def directory(reader) -> dict[str, tuple[int, int, int]]:
    """Members of a ZIP file: name -> (offset of its data, stored size, method),
    from the central directory (ZIP64 or not)."""
    tail_at = max(0, reader.size - 22 - 65535 - 20)
    tail = reader.read(tail_at, reader.size - tail_at)
    # A record of 22 bytes and its comment end the file; the comment itself may
    # hold the signature.
    end = tail.rfind(b"PK\x05\x06", 0, max(0, len(tail) - 18))
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end + 3)
    if end < 0:
        raise ValueError("no end-of-central-directory record")
    n, size, at = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF == n or 0xFFFFFFFF in (size, at):
        if end < 20 or tail[end - 20:end - 16] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        place = struct.unpack_from("<Q", tail, end - 12)[0]
        record = reader.read(place, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        n, size, at = struct.unpack_from("<QQQ", record, 32)
    entries, members, p = reader.read(at, size), {}, 0
    for _ in range(n):
        if entries[p:p + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", entries, p + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", entries, p + 20)
        local = struct.unpack_from("<I", entries, p + 42)[0]
        name = entries[p + 46:p + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        q, last = p + 46 + n_name, p + 46 + n_name + n_extra
        while q + 4 <= last:
            kind, length = struct.unpack_from("<HH", entries, q)
            if kind == 1:  # ZIP64: 8 bytes for each field that overflowed, in order
                fields, r = [plain, packed, local], q + 4
                for i, value in enumerate(fields):
                    if value == 0xFFFFFFFF:
                        fields[i] = struct.unpack_from("<Q", entries, r)[0]
                        r += 8
                plain, packed, local = fields
            q += 4 + length
        head = reader.read(local, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header for {name}")
        data = local + 30 + sum(struct.unpack_from("<HH", head, 26))
        members[name] = (data, packed, method)
        p = last + n_comment
    return members


def _ranges(uri: str) -> Iterator[tuple[str, int, int, bytes]]:
    """Runs of neighbouring records of one archive, from its index."""
    with RangeReader(uri) as reader:
        members = directory(reader)
        archives = [m for n, m in members.items() if n.startswith("archive/")]
        indexes = [m for n, m in members.items() if n.startswith("indexes/")]
        if len(archives) != 1 or len(indexes) != 1 or archives[0][2] or indexes[0][2]:
            raise ValueError(f"{uri}: one stored archive and one stored index expected")
        base = archives[0][0]
        lines = reader.read(*indexes[0][:2]).splitlines()
    run: list[tuple[int, int]] = []
    for line in lines:
        place = json.loads(line[line.index(b" ") + 1:])
        if run and run[-1][0] + run[-1][1] - run[0][0] + place["length"] > RANGE_BYTES:
            yield _packed(uri, base, run)
            run = []
        run.append((place["offset"], place["length"]))
    if run:
        yield _packed(uri, base, run)


def _packed(uri: str, base: int, run: list[tuple[int, int]]) -> tuple[str, int, int, bytes]:
    first, last = base + run[0][0], base + run[-1][0] + run[-1][1]
    places = np.array([(base + o - first, n) for o, n in run], dtype="<i8")
    return uri, first, last, places.tobytes()


def _head(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = (x.partition(":") for x in head.decode("utf-8").split("\r\n")[1:])
    return {k.lower(): v.strip() for k, _, v in fields}, rest


def _page_of(urn: str | None) -> str | None:
    return (urn or "").strip("<>").rpartition(":")[2] or None


def parse_record(member: bytes, with_payload: bool) -> tuple:
    warc, rest = _head(zlib.decompress(member, 31))
    http, body = _head(rest[:int(warc["content-length"])])
    kind = warc["warc-type"]
    length = int(http["content-length"])
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(body) != length or base32_sha1(body) != digest):
        raise ValueError(f"{warc['warc-record-id']}: payload does not match its header")
    return (warc["warc-record-id"], kind, warc["warc-target-uri"],
            _page_of(warc["warc-record-id"]), _page_of(warc.get("warc-refers-to")),
            length, digest, body if with_payload and kind == "response" else None)


def read_archives(paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives whose URIs are in column ``path``. Digests of
    responses are recomputed from the payload read and checked."""
    python_ready(paths)

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                rows = list(_ranges(uri))
                yield pd.DataFrame(rows, columns=["path", "first", "last", "places"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        for batch in batches:
            for uri, first, last, places in zip(*(batch[c] for c in
                                                  ("path", "first", "last", "places"))):
                with RangeReader(uri) as reader:
                    raw = reader.read(int(first), int(last - first))
                rows = [parse_record(raw[a:a + n], with_payload)
                        for a, n in np.frombuffer(places, dtype="<i8").reshape(-1, 2).tolist()]
                yield pd.DataFrame(rows, columns=names)

    tasks = max(1, paths.sparkSession.sparkContext.defaultParallelism)
    return (paths.select("path").mapInPandas(locate, RANGES)
            .repartition(4 * tasks).mapInPandas(read, RECORDS)
            .withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")}))


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """URIs of the archives in a folder (listed by Spark; contents not read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
            .select("path"))


def op5_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"), fresh_dir(spark, "warc"))
    return (read_archives(manifest, with_payload=False)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"CAST((('0x' || substr(h, {5 * (i // 4) + 1}, 5))::BIGINT >> {15 - 5 * (i % 4)}) & 31 "
    f"AS INTEGER) + 1, 1)" for i in range(32))

OP5_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha1(coalesce(html, '')) AS h FROM pages),
c AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN NULL ELSE top END AS refers_to
FROM c
"""
