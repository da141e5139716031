"""Extraction of many archives with the entries of each spread over tasks.

A first pass reads each archive's directory and cuts the archive into its
entries' bytes; running sums hold the caps there. The entries are dealt to tasks
one by one, whatever archive they are from, inflated and verified. The first bad
entry of an archive, if there is one, stands for the archive: nothing of it is kept.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import archive
from millrace.operators.archive import MAX_ENTRIES, MAX_ENTRY_BYTES, MAX_TOTAL_BYTES, Entry
from millrace.storage import Tables

#: Packed bytes in one batch between Spark and Python.
BATCH_BYTES = 1 << 24
SLICE = pa.schema([("ordinal", pa.int32()), ("name", pa.string()), ("method", pa.int32()), ("size", pa.int64()), ("crc", pa.int64()), ("error", pa.string()), ("packed", pa.binary())])
SLICE_SQL = "ordinal int, name string, method int, size long, crc long, error string, packed binary"


def slices(data: bytes, max_entries: int, max_entry: int, max_total: int) -> Iterator[tuple]:
    """The files of an archive, packed, up to the first that its directory or its header shows to be bad. Ordinal -1: the archive as a whole."""
    try:
        entries = archive.directory(data)
        if len(entries) > max_entries:
            raise archive.ArchiveError("TOO_MANY", str(len(entries)))
    except (archive.ArchiveError, struct.error) as x:
        yield -1, None, None, None, None, getattr(x, "code", "CORRUPT"), None
        return
    total = 0
    for i, e in enumerate(entries):
        try:
            name = archive.safe_name(e.name)
            if e.is_dir:
                continue
            total += e.uncompressed_size
            for code, refused in archive.REFUSALS:
                if refused(e, total, max_entry, max_total):
                    raise archive.ArchiveError(code, name)
            yield i, name, e.method, e.uncompressed_size, e.crc32, None, archive.packed_bytes(data, e)
        except (archive.ArchiveError, struct.error) as x:
            yield i, None, None, None, None, getattr(x, "code", "CORRUPT"), None
            return


def entry_slices(df: DataFrame, key: str, content: str, max_entries: int = MAX_ENTRIES, max_entry: int = MAX_ENTRY_BYTES, max_total: int = MAX_TOTAL_BYTES) -> DataFrame:
    """key and the slices of each archive; one archive is in memory at a time, and its slices leave in batches."""
    kind = df.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, held, size = batch.slice(i, 1), [], 0
                data = one.column(1)[0].as_py() or b""
                for row in slices(data, max_entries, max_entry, max_total):
                    held.append(row)
                    size += len(row[-1] or b"")
                    if size >= BATCH_BYTES:
                        yield packed(one, held)
                        held, size = [], 0
                if held:
                    yield packed(one, held)

    def packed(one: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        keys = one.column(0).take(pa.array([0] * len(rows)))
        return pa.RecordBatch.from_arrays([keys, *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SLICE, strict=True))], [key, *SLICE.names])

    return df.select(key, content).mapInArrow(cut, f"`{key}` {kind}, {SLICE_SQL}")


def inflated(parts: DataFrame, key: str) -> DataFrame:
    """Slices with ``content`` in place of the packed bytes, or an error where size or checksum differ."""
    kind = parts.schema[key].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = one.to_pylist()[0]
                data, error = None, row["error"]
                if error is None:
                    try:
                        data = archive.verified(row["packed"], Entry(row["name"], row["method"], 0, 0, row["size"], 0, row["crc"], 0))
                    except (archive.ArchiveError, zlib.error) as x:
                        error = getattr(x, "code", "CORRUPT")
                yield pa.RecordBatch.from_arrays([one.column(0), *(one.column(c) for c in ("ordinal", "name", "size", "crc")), pa.array([error], pa.string()), pa.array([data], pa.binary())], [key, "ordinal", "name", "size", "crc", "error", "content"])

    return parts.mapInArrow(check, f"`{key}` {kind}, ordinal int, name string, size long, crc long, error string, content binary")


def extract_all(df: DataFrame, tasks: int, key: str = "archive", content: str = "content", max_entries: int = MAX_ENTRIES, max_entry: int = MAX_ENTRY_BYTES, max_total: int = MAX_TOTAL_BYTES) -> DataFrame:
    """key, ordinal, name, size, crc, content, error: every file of the good archives, and one row with the error of each bad one.

    Entries count from 0 in the order of the directory, folders included. An archive is
    as bad as its first bad entry: an unsafe name, an unknown method, encryption,
    a size beyond a cap (its own, or the running sum's), bytes outside the archive,
    a size or checksum that differs; the ordinal is that of the entry, -1 if the
    archive's directory is at fault. Null content is no archive. ``key`` tells
    archives apart. Entries are dealt to ``tasks`` tasks.
    """
    tables = Tables(df.sparkSession)
    parts = entry_slices(df, key, content, max_entries, max_entry, max_total).repartition(tasks, key, "ordinal")
    files = tables.write(inflated(parts, key), "entries")
    bad = files.filter("error is not null").groupBy(key).agg(F.min_by("error", "ordinal").alias("error"), F.min("ordinal").alias("ordinal"))
    good = files.join(bad.select(key), key, "left_anti").select(key, "ordinal", "name", "size", "crc", "content", "error")
    none: list[Column] = [F.lit(None).cast(t).alias(c) for c, t in (("name", "string"), ("size", "long"), ("crc", "long"), ("content", "binary"))]
    return good.unionByName(bad.select(key, "ordinal", *none, "error"))


def packed(df: DataFrame, key: str, order: str, name: str, content: str) -> DataFrame:
    """key and a ZIP archive of the rows of each key, in order; a key's rows fit in a task."""
    kind = df.schema[key].dataType.simpleString()

    def pack(keys: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for row in table.sort_by(order).to_pylist():
                z.writestr(zipfile.ZipInfo(row[name]), row[content] or b"", zipfile.ZIP_DEFLATED)
        return pa.table({key: pa.array([keys[0].as_py()], table.schema.field(key).type), "content": pa.array([out.getvalue()], pa.binary())})

    return df.select(key, order, name, content).groupBy(key).applyInArrow(pack, f"`{key}` {kind}, content binary")
