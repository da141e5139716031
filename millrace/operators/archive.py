"""ZIP archives: directory scan and safe extraction as table functions over ``binaryFile`` content."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Caps of an archive.
MAX_ENTRIES, MAX_ENTRY_BYTES, MAX_TOTAL_BYTES = 4096, 256 * 1024 * 1024, 1024 * 1024 * 1024
ENTRY_SCHEMA = "ordinal int, name string, method int, flags int, compressed_size long, uncompressed_size long, local_offset long, crc32 long, external_attr long, is_dir boolean"


class ArchiveError(ValueError):
    def __init__(self, code: str, text: str):
        super().__init__(f"{code}: {text}")
        self.code = code


@dataclass
class Entry:
    name: str
    method: int
    flags: int
    compressed_size: int
    uncompressed_size: int
    local_offset: int
    crc32: int
    external_attr: int

    @property
    def is_dir(self) -> bool:
        return self.name.endswith("/") or bool(self.external_attr & 0x10)


def directory(data: bytes) -> list[Entry]:
    """Entries of the central directory; archives in parts, 64-bit ones and damaged ones are errors."""
    end = data.rfind(b"PK\x05\x06", max(0, len(data) - 22 - 65535))
    if end < 0 or end + 22 > len(data):
        raise ArchiveError("CORRUPT", "no end record")
    disk, start_disk, here, total, size, offset = struct.unpack_from("<HHHHII", data, end + 4)
    if disk or start_disk or here != total:
        raise ArchiveError("UNSUPPORTED", "several disks")
    if total == 0xFFFF or size == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        raise ArchiveError("UNSUPPORTED", "64-bit archive")
    out, at, stop = [], offset, offset + size
    if stop > end:
        raise ArchiveError("CORRUPT", "directory outside the file")
    for _ in range(total):
        if at + 46 > stop or data[at : at + 4] != b"PK\x01\x02":
            raise ArchiveError("CORRUPT", "bad directory record")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        crc, packed, plain, n, extra, comment = struct.unpack_from("<IIIHHH", data, at + 16)
        attr, local = struct.unpack_from("<II", data, at + 38)
        if at + 46 + n + extra + comment > stop:
            raise ArchiveError("CORRUPT", "directory record is cut")
        if 0xFFFFFFFF in (packed, plain, local):
            raise ArchiveError("UNSUPPORTED", "64-bit entry")
        out.append(Entry(data[at + 46 : at + 46 + n].decode("utf-8", "replace"), method, flags, packed, plain, local, crc, attr))
        at += 46 + n + extra + comment
    return out


def safe_name(name: str) -> str:
    name = name.replace("\\", "/")
    parts = [p for p in name.split("/") if p not in ("", ".")]
    if re.match(r"[A-Za-z]:|/", name) or ".." in parts or not parts:
        raise ArchiveError("UNSAFE", name)
    return "/".join(parts)


def packed_bytes(data: bytes, e: Entry) -> bytes:
    if data[e.local_offset : e.local_offset + 4] != b"PK\x03\x04":
        raise ArchiveError("CORRUPT", "bad local header")
    n, extra = struct.unpack_from("<HH", data, e.local_offset + 26)
    at = e.local_offset + 30 + n + extra
    if at + e.compressed_size > len(data):
        raise ArchiveError("CORRUPT", "data outside the file")
    return data[at : at + e.compressed_size]


def content(data: bytes, e: Entry) -> bytes:
    """The whole content, its size and CRC verified."""
    return verified(packed_bytes(data, e), e)


def verified(raw: bytes, e: Entry) -> bytes:
    if e.method == 8:
        raw = zlib.decompressobj(-15).decompress(raw, e.uncompressed_size + 1)
    if len(raw) != e.uncompressed_size:
        raise ArchiveError("CORRUPT", "size differs")
    if zlib.crc32(raw) != e.crc32:
        raise ArchiveError("CORRUPT", "CRC differs")
    return raw


def extract(data: bytes, max_entries: int = MAX_ENTRIES, max_entry: int = MAX_ENTRY_BYTES, max_total: int = MAX_TOTAL_BYTES) -> Iterator[tuple[str, bytes]]:
    """(relative name, content) of the files; the first bad entry is an error for the archive."""
    for name, e in admitted(directory(data), max_entries, max_entry, max_total):
        yield name, content(data, e)


#: What an entry must not be, in the order of the checks.
REFUSALS = (
    ("UNSUPPORTED", lambda e, total, cap, most: e.method not in (0, 8)),
    ("UNSUPPORTED", lambda e, total, cap, most: bool(e.flags & 1)),
    ("TOO_LARGE", lambda e, total, cap, most: e.uncompressed_size > cap),
    ("TOO_LARGE", lambda e, total, cap, most: total > most),
)


def admitted(entries: list[Entry], max_entries: int = MAX_ENTRIES, max_entry: int = MAX_ENTRY_BYTES, max_total: int = MAX_TOTAL_BYTES) -> list[tuple[str, Entry]]:
    """(relative name, entry) of the files, or the first refusal."""
    if len(entries) > max_entries:
        raise ArchiveError("TOO_MANY", str(len(entries)))
    out, total = [], 0
    for e in entries:
        name = safe_name(e.name)
        if not e.is_dir:
            total += e.uncompressed_size
            for code, refused in REFUSALS:
                if refused(e, total, max_entry, max_total):
                    raise ArchiveError(code, name)
            out.append((name, e))
    return out


def entry_text(data: bytes, name: str, cap: int) -> tuple[bytes, bool, int] | None:
    """(bytes, truncated, full size) of one entry; beyond ``cap`` a prefix that is inflated only so far."""
    for e in directory(data):
        if safe_name(e.name) != name or e.is_dir:
            continue
        if e.method not in (0, 8):
            raise ArchiveError("UNSUPPORTED", f"method {e.method}")
        if e.uncompressed_size > cap:
            raw = packed_bytes(data, e)
            return (zlib.decompressobj(-15).decompress(raw, cap) if e.method == 8 else raw[:cap]), True, e.uncompressed_size
        return content(data, e), False, e.uncompressed_size
    return None


def main_document(names: list[str]) -> str | None:
    """``full.md`` itself, else the first one in a folder."""
    return "full.md" if "full.md" in names else next((n for n in names if n.endswith("/full.md")), None)


@F.udtf(returnType=ENTRY_SCHEMA + ", error string")
class ZipScan:
    def eval(self, data: bytes):
        try:
            for i, e in enumerate(directory(data)):
                yield i, e.name, e.method, e.flags, e.compressed_size, e.uncompressed_size, e.local_offset, e.crc32, e.external_attr, e.is_dir, None
        except (ArchiveError, struct.error) as x:
            yield (None,) * 10 + (getattr(x, "code", "CORRUPT"),)


@F.udtf(returnType="ordinal int, name string, size long, content binary, error string")
class ZipExtract:
    """All files of an archive or, if any is bad, one row with the error.

    A first pass inflates and verifies every file and keeps none; a second one
    yields them, so no more than one file's content is held.
    """

    def eval(self, data: bytes):
        try:
            files = admitted(directory(data))
            for _, e in files:
                content(data, e)
        except (ArchiveError, struct.error, zlib.error) as x:
            yield None, None, None, None, getattr(x, "code", "CORRUPT")
            return
        for i, (name, e) in enumerate(files):
            yield i, name, e.uncompressed_size, content(data, e), None


def _lateral(df: DataFrame, udtf, column: str) -> DataFrame:
    return df.lateralJoin(udtf(F.col(column).outer())).drop(column)


def scan(df: DataFrame, column: str = "content") -> DataFrame:
    return _lateral(df, ZipScan, column)


def extracted(df: DataFrame, column: str = "content") -> DataFrame:
    return df.lateralJoin(ZipExtract(F.col(column).outer()).alias("f")).select(*(df[c] for c in df.columns if c != column), "f.*")


def unsigned32(value: Column) -> Column:
    """A little-endian unsigned number of four bytes."""
    return F.conv(F.hex(F.reverse(value)), 16, 10).cast("long")


@F.udtf(returnType="text binary, truncated boolean, bytes long, error string")
class MainText:
    """The main document's bytes up to ``cap``, whether they are a part, and its size; an archive without one has an empty text."""

    def eval(self, data: bytes, cap: int):
        try:
            name = main_document([safe_name(e.name) for e in directory(data) if not e.is_dir])
            text, part, size = (entry_text(data, name, cap) if name else None) or (b"", False, 0)
            yield text, part, size, None
        except (ArchiveError, struct.error, zlib.error) as x:
            yield None, None, None, getattr(x, "code", "CORRUPT")


def main_texts(df: DataFrame, cap: int, column: str = "content") -> DataFrame:
    return df.lateralJoin(MainText(F.col(column).outer(), F.lit(cap)).alias("f")).select(*(df[c] for c in df.columns if c != column), "f.*")
