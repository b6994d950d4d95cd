"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole records, and at its end a seek table:
a skippable frame with the compressed and decompressed size of every frame.  Any Zstandard reader decompresses
the file as one stream; a reader that knows the table gets at one record by decompressing one frame.  The index
maps a record to its frame and its offset in the decompressed frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tableloom.llm import wordscan as ws
from tableloom.llm.files import file_size, read_range, writing
from tableloom.scratch import Scratch

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
# Fixed values of the archive format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

URN = "urn:page:"
READ_BYTES = 16 << 20  # of decompressed records that one task reads, about
INDEX = "page_id long, url string, file string, frame int, frame_start long, frame_size long, start long, size long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _plain(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response with its payload, or a revisit that has the HTTP header of the whole response only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_plain(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """One record's fields; the payload's digest is computed anew where there is a payload and must be the header's."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != length or digest(payload) != said):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(x) if (x := fields.get(name, "").removeprefix(f"<{URN}").removesuffix(">")) else None
    return {"page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "payload_bytes": length, "payload_digest": said, "refers_to": number("WARC-Refers-To"), "payload": payload if whole else None}


def seek_table(path: str) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of a bundle's frames, from its footer."""
    size = file_size(path)
    n, flags, magic = struct.unpack("<IBI", read_range(path, size - 9, 9))
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError(f"{path} has no seek table")
    entries = struct.iter_unpack("<II", read_range(path, size - 9 - 8 * n, 8 * n))
    out, at = [], 0
    for packed, plain in entries:
        out.append((at, packed, plain))
        at += packed
    return out


def write_bundle(path: str, records: Iterator[tuple], frame_bytes: int, level: int) -> list[tuple]:
    """Writes (page_id, url, bytes) records; gives an index row of each, without the file."""
    index, sizes, at = [], [], 0
    coder = zstandard.ZstdCompressor(level=level)
    with writing(path) as out:
        held, held_rows = [], []

        def close() -> None:
            nonlocal at
            plain = b"".join(held)
            packed = coder.compress(plain)
            out.write(packed)
            index.extend((*row[:2], len(sizes), at, len(packed), *row[2:]) for row in held_rows)
            sizes.append((len(packed), len(plain)))
            at += len(packed)
            held.clear()
            held_rows.clear()

        offset = 0
        for page_id, url, raw in records:
            held_rows.append((page_id, url, offset, len(raw)))
            held.append(raw)
            offset += len(raw)
            if offset >= frame_bytes:
                close()
                offset = 0
        if held:
            close()
        body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
        out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
    return index


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, min_bytes: int = 0, bundle_bytes: int = 32 << 20, frame_bytes: int = 256 << 10, level: int = 3, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes a record per row of pages (page_id, url, html) to bundles in folder; gives their index as a table.

    Of the records whose payloads are equal and of at least min_bytes, the one of the smallest page_id is a
    response and the others are its revisits; a payload without any page_id makes responses only.
    """
    html = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    bundles = max(1, -(-total // bundle_bytes))
    # The payload is part of the hash: rows that share or lack an id and a url don't meet in one bundle.
    bundle = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(bundles)).alias("bundle")
    sums = scratch.save(pages.filter(F.octet_length("html") >= min_bytes).select("page_id", F.sha1("html").alias("sha1"), bundle), "sums")
    first = sums.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").drop("n")
    again = sums.join(first, "sha1").filter(~F.col("page_id").eqNullSafe(F.col("first"))).select("bundle", "page_id", "sha1", "first")

    def write(pages: pa.Table, again: pa.Table) -> pa.Table:
        number = pages["bundle"][0].as_py()
        refers = {(p, s): f for p, s, f in zip(*(again[c].to_pylist() for c in ("page_id", "sha1", "first")), strict=True)}

        def records() -> Iterator[tuple]:
            for part in pages.to_batches(max_chunksize=256):
                for page_id, url, payload in zip(*(part[c].to_pylist() for c in ("page_id", "url", "html")), strict=True):
                    refers_to = refers.get((page_id, hashlib.sha1(payload, usedforsecurity=False).hexdigest())) if refers else None
                    yield page_id, url, record(page_id, url, payload, refers_to, date)

        file = f"{folder}/bundle-{number:08d}.warc.zst"
        rows = write_bundle(file, records(), frame_bytes, level)
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        page_id, url, *rest = (pa.array(c, k) for c, k in zip(columns, kinds, strict=True))
        return pa.table([page_id, url, pa.array([file] * len(rows), pa.string()), *rest], [f.split()[0] for f in INDEX.split(", ")])

    both = pages.withColumn("bundle", bundle).groupBy("bundle").cogroup(again.groupBy("bundle"))
    return scratch.save(both.applyInArrow(write, INDEX), "index")


def read_archives(index: DataFrame, payload: bool = False) -> DataFrame:
    """The records that rows of an index point at: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    Each frame that is asked for is decompressed once.  With payload, responses carry theirs.
    """
    fields = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * payload
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())

    def read(table: pa.Table) -> pa.Table:
        file, k, at, size = (table[c][0].as_py() for c in ("file", "frame", "frame_start", "frame_size"))
        plain = zstandard.ZstdDecompressor().decompress(read_range(file, at, size))
        rows = [parse(plain[s : s + n]) for s, n in zip(table["start"].to_pylist(), table["size"].to_pylist(), strict=True)]
        return pa.table([pa.array([r[c] for r in rows], t) for c, t in zip(names, kinds, strict=False)], names)

    # By bytes to read, not by the size of the index, which is tiny; of a given number, so it stays.
    tasks = max(1, -(-(index.agg(F.sum("size")).first()[0] or 0) // READ_BYTES))
    return index.repartition(tasks, "file", "frame").groupBy("file", "frame").applyInArrow(read, fields)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes pages (page_id, url, html) to archives in the shared folder and reads every record back.

    A null html is an empty payload, a null url no target.  Rows that repeat a page_id with the payload's smallest
    page_id are responses each; a null page_id is never referred to.  No rows write no bundles.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    ws.small_batches(pages.sparkSession)
    return read_archives(write_archives(pages, scratch.table("archives"), scratch, min_bytes))


