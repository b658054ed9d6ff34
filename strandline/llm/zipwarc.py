"""WARC records in ZIP-packaged archives: a writer, and a reader that never extracts.

An archive is a ZIP file with stored members: ``archive/data.warc.gz`` (one gzip member per record)
and ``indexes/index.cdxj`` (offset and length of each record). The reader parses the end record, the
ZIP64 end record and the central directory itself, finds where each stored member's bytes begin,
reads the index, and fetches records by ranges of the one file; nothing is unpacked to disk. An
archive without an index is read by walking the gzip members in order.

Scale: writers stream (a record at a time, a new volume after ``volume_bytes``), write under names of
their own attempt in the shared folder, and only the volumes that the manifest names are read, so a
lost or repeated task leaves no record twice. Readers get ranges of about ``chunk_bytes``, dealt
evenly, whatever the sizes of the archives. Files are opened through pyarrow's file systems, by URI.

Edge cases: null payloads are empty, null urls have no target line, null page ids are written as an
empty name and count as largest when the first of equal payloads is chosen. Repeated page rows with the
smallest page id are all responses. An empty table writes no archive and gives an empty result.
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
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import shared_dir, stash

# The member names, and the signatures of the ZIP format.
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
END_SIG, END64_SIG, LOCATOR64_SIG, ENTRY_SIG, LOCAL_SIG = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
NAME = "urn:page:"


def open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# ---- ZIP directories -------------------------------------------------------------------------


def read_directory(f, size: int) -> dict[str, dict]:
    """Members of the ZIP file ``f``: name -> method, size, stored_size, start (of the member's own bytes).

    f needs seek and read only; ZIP64 end records and extra fields are followed where present.
    """
    tail_at = max(0, size - (22 + 65535 + 20))
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    end = tail.rfind(END_SIG)
    if end < 0:
        raise ValueError("not a ZIP file: no end of central directory")
    count, cd_size, cd_at = struct.unpack("<HLL", tail[end + 10 : end + 20])
    if (count == 0xFFFF or cd_size == 0xFFFFFFFF or cd_at == 0xFFFFFFFF) and end >= 20 and tail[end - 20 : end - 16] == LOCATOR64_SIG:
        f.seek(struct.unpack("<Q", tail[end - 12 : end - 4])[0])
        record = f.read(56)
        if record[:4] != END64_SIG:
            raise ValueError("broken ZIP64 end record")
        count, cd_size, cd_at = struct.unpack("<QQQ", record[32:56])
    f.seek(cd_at)
    directory, at, members = f.read(cd_size), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != ENTRY_SIG:
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<HH", directory[at + 8 : at + 12])
        stored, plain, n_name, n_extra, n_comment = struct.unpack("<LLHHH", directory[at + 20 : at + 34])
        (local,) = struct.unpack("<L", directory[at + 42 : at + 46])
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:  # ZIP64: only the fields that are full above, in this order
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                local = next(wide) if local == 0xFFFFFFFF else local
            extra = extra[4 + n :]
        f.seek(local)
        head = f.read(30)
        if head[:4] != LOCAL_SIG:
            raise ValueError(f"broken local header of {name}")
        members[name] = {"method": method, "size": plain, "stored_size": stored, "start": local + 30 + sum(struct.unpack("<HH", head[26:30]))}
        at += 46 + n_name + n_extra + n_comment
    return members


# ---- records ---------------------------------------------------------------------------------


def make_record(page_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record; a revisit has the HTTP header, with the payload's full length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{NAME}{page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~-._"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{NAME}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Headers (lower-cased names) and payload of one WARC record, its length and digest checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if len(block) != int(headers["content-length"]):
        raise ValueError("a record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    said = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(payload))
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].partition(":")[2]
    if kind == "response":
        said = len(payload)
        if (found := base64.b32encode(hashlib.sha1(payload).digest()).decode()) != digest:
            raise ValueError(f"payload digest {found} instead of {digest}")
    return {"headers": headers, "payload": payload, "payload_bytes": said, "payload_digest": digest, "record_type": kind}


def _id_in(value: str | None) -> int | None:
    inner = (value or "").strip("<>").removeprefix(NAME)
    return int(inner) if inner else None


# ---- writing ---------------------------------------------------------------------------------


class _Volume:
    def __init__(self, folder: str, level: int):
        self.uri = f"{folder}/{uuid.uuid4().hex}.zip"
        files, path = open_fs(self.uri)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.level, self.index, self.at = files.open_output_stream(path), level, [], 0
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(DATA, "w", force_zip64=True)

    def add(self, record: bytes, entry: dict) -> None:
        z = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        packed = z.compress(record) + z.flush()
        self.member.write(packed)
        self.index.append(json.dumps(entry | {"offset": self.at, "length": len(packed)}))
        self.at += len(packed)

    def close(self) -> dict:
        self.member.close()
        self.zip.writestr(INDEX, "\n".join(self.index))
        self.zip.close()
        self.out.close()
        return {"archive": self.uri, "n_records": len(self.index), "n_bytes": self.at}


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, volume_bytes: int = 64 << 20, level: int = 6) -> DataFrame:
    """Writes a record per page (page_id, url, html) into ZIP archives under ``folder``; gives the manifest
    (archive, n_records, n_bytes).

    Of equal payloads of at least ``min_revisit_bytes`` the smallest page id is a response, others revisit it.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    again = pages.filter(F.octet_length("html") >= min_revisit_bytes).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    again = stash(again.filter("n > 1 and first is not null").select("sha1", "first"), "payloads")
    rows = pages.join(again, "sha1", "left").select("page_id", "url", "html", "sha1", F.expr("case when first <> page_id or page_id is null then first end").alias("refers_to"))
    text = lambda x: None if x is None or pd.isna(x) else str(int(x))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        volume = None
        for batch in batches:
            for page_id, url, html, sha1, refers_to in zip(*(batch[c].tolist() for c in ("page_id", "url", "html", "sha1", "refers_to")), strict=True):
                volume = volume or _Volume(folder, level)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                volume.add(make_record(text(page_id) or "", url, html.encode(), digest, text(refers_to)), {"url": url, "digest": digest})
                if volume.at >= volume_bytes:
                    yield pd.DataFrame([volume.close()])
                    volume = None
        if volume:
            yield pd.DataFrame([volume.close()])

    as_text = rows.select(F.col("page_id").cast("decimal(20,0)").cast("string").alias("page_id"), "url", "html", "sha1", F.col("refers_to").cast("string").alias("refers_to"))
    return stash(as_text.mapInPandas(write, "archive string, n_records long, n_bytes long"), "manifest")


# ---- reading ---------------------------------------------------------------------------------


def plan_ranges(archives: DataFrame, chunk_bytes: int = 4 << 20) -> DataFrame:
    """archives (archive) -> archive, start, end, lengths: ranges of whole records inside stored members."""

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["archive"]:
                files, path = open_fs(uri)
                with files.open_input_file(path) as f:
                    members = read_directory(f, f.size())
                    data = members[DATA]
                    if data["method"] != 0:
                        raise ValueError(f"{DATA} is not stored in {uri}")
                    ranges = [[data["start"], data["start"] + data["stored_size"], []]]
                    if INDEX in members and members[INDEX]["method"] == 0:
                        f.seek(members[INDEX]["start"])
                        ranges = []
                        for line in f.read(members[INDEX]["stored_size"]).splitlines():
                            x = json.loads(line)
                            at = data["start"] + x["offset"]
                            if not ranges or ranges[-1][1] != at or at - ranges[-1][0] >= chunk_bytes:
                                ranges.append([at, at, []])
                            ranges[-1][1] = at + x["length"]
                            ranges[-1][2].append(x["length"])
                yield pd.DataFrame([(uri, a, b, lengths) for a, b, lengths in ranges], columns=["archive", "start", "end", "lengths"])

    return archives.select("archive").mapInPandas(plan, "archive string, start long, end long, lengths array<long>")


def _members(f, start: int, end: int, lengths: list[int], step: int = 1 << 20) -> Iterator[bytes]:
    """Decompressed gzip members of a range, one at a time."""
    f.seek(start)
    if len(lengths):
        for n in lengths:
            yield zlib.decompress(f.read(int(n)), 31)
        return
    left, data, z, parts = end - start, b"", zlib.decompressobj(31), []
    while left or data:
        if not data:
            data = f.read(min(step, left))
            left -= len(data)
        parts.append(z.decompress(data))
        data = z.unused_data
        if z.eof:
            yield b"".join(parts)
            z, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("a gzip member is cut short")


def read_archives(archives: DataFrame, chunk_bytes: int = 4 << 20) -> DataFrame:
    """Records of the archives (archive): page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest."""
    ranges = plan_ranges(archives, chunk_bytes)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, start, end, lengths in batch.itertuples(index=False):
                files, path = open_fs(uri)
                with files.open_input_file(path) as f:
                    rows, n = [], 0
                    for record in _members(f, start, end, lengths):
                        x = parse_record(record)
                        h = x["headers"]
                        rows.append((_id_in(h["warc-record-id"]), h.get("warc-target-uri"), x["record_type"], _id_in(h.get("warc-refers-to")), x["payload"], x["payload_bytes"], x["payload_digest"]))
                        n += len(x["payload"])
                        if n > 8 << 20:
                            yield _frame(rows)
                            rows, n = [], 0
                    yield _frame(rows)

    n = max(2, archives.sparkSession.sparkContext.defaultParallelism)
    spread = ranges.repartition(n * 2, "archive", "start")
    return spread.mapInPandas(fetch, "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"])
    return df.astype({"page_id": "Int64", "refers_to": "Int64"})


def archive_folder(spark) -> str:
    """A new folder for archives in the shared folder."""
    return f"{shared_dir(spark)}/archives-{uuid.uuid4().hex}"
